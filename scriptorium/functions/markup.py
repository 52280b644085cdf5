"""Column functions over structured text: headers, cleaning, hidden notes, fences, JSON, samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .script import strip

HIDE, HIDE_END = "<!-- hide -->", "<!-- /hide -->"
SCRIPTS = ("devanagari", "roman", "kannada")


def frontmatter(c: Column) -> Column:
    """Struct (header, body) of a document that starts with a ``---`` block; nulls without one."""
    pattern = "(?s)^---\\n(.*?)\\n---\\n(.*)$"
    ok = c.rlike(pattern)
    return F.struct(F.when(ok, F.regexp_extract(c, pattern, 1)).alias("header"), F.when(ok, strip(F.regexp_extract(c, pattern, 2))).alias("body"))


def lenient_frontmatter(c: Column) -> Column:
    """Struct (header, body): a closing line of dashes, else dashes at the end; without them all is body."""
    closed, open_end = "(?s)^---\\n(.*?)\\n---\\n(.*)$", "(?s)^---\\n(.*?)\\n---(.*)$"
    header = F.when(c.rlike(closed), F.regexp_extract(c, closed, 1)).when(c.rlike(open_end), F.regexp_extract(c, open_end, 1))
    body = F.when(c.rlike(closed), F.regexp_extract(c, closed, 2)).when(c.rlike(open_end), F.regexp_extract(c, open_end, 2)).otherwise(c)
    return F.struct(header.alias("header"), body.alias("body"))


def third_part(c: Column, mark: str = "---") -> Column:
    """What stands after the second mark; the whole text with fewer marks."""
    parts = F.split(c, mark, 3)
    return F.when(F.size(parts) == 3, F.get(parts, F.lit(2))).otherwise(c)


def header_value(c: Column, key: str) -> Column:
    """The value of the first line ``key: value``; null without one."""
    found = F.regexp_extract(c, f"(?m)^{key}:[ \\t]*(.*?)[ \\t]*$", 1)
    return F.when(found != "", F.regexp_replace(found, "^[\"']|[\"']$", ""))


def toml_header(c: Column) -> Column:
    """Struct (header map or null, body) of a text that starts with a ``+++`` block of ``key = value`` lines."""
    pattern = "(?s)^\\+\\+\\+\\n(.*?)\\n\\+\\+\\+\\n?(.*)$"
    lines = F.filter(F.split(F.regexp_extract(c, pattern, 1), "\n"), lambda x: F.contains(x, F.lit("=")))
    pairs = F.transform(
        lines,
        lambda x: F.struct(
            strip(F.substring_index(x, "=", 1)).alias("k"),
            F.regexp_replace(strip(F.regexp_replace(x, "^[^=]*=", "")), "^[\"']|[\"']$", "").alias("v"),
        ),
    )
    # the last line of a key wins
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return F.struct(F.when(c.rlike(pattern), F.map_from_entries(last)).alias("header"), F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 2)).otherwise(c).alias("body"))


def cleaned(c: Column, skip_headings: bool = True) -> Column:
    """For comparison: without header, headings, comments, bold marks; white space as one space."""
    text = strip(c)
    for mark in ("---", "\\+\\+\\+"):
        text = F.regexp_replace(text, f"(?s)^{mark}.*?{mark}", "")  # names the text once, so each step is done once
    if skip_headings:
        text = F.regexp_replace(text, "(?mU)^#+\\s+.*$", "")
    text = F.regexp_replace(text, "(?s)<!--.*?-->", " ")
    text = F.replace(text, F.lit("**"), F.lit(""))
    return strip(F.regexp_replace(text, "(?U)\\s+", " "))


def without_tags(c: Column) -> Column:
    """Without tags; three or more line feeds become two; stripped."""
    return strip(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), "\\n{3,}", "\n\n"))


def hide_notes(c: Column) -> Column:
    """Wrap ``[note]`` in hide marks, but for links ``[x](y)`` and what is hidden already."""
    parts = F.split(c, f"(?={HIDE})|(?<={HIDE_END})")
    wrap = lambda x: F.regexp_replace(x, "(\\\\*\\[[^\\]]+?\\])(?!\\()", f"{HIDE}$1{HIDE_END}")
    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike(f"(?s)^{HIDE}.*{HIDE_END}$"), x).otherwise(wrap(x))), "")


def without_noise(c: Column) -> Column:
    """Runs of bold marks as one, no space inside bold, one form of numbers between verse marks."""
    text = F.regexp_replace(c, "\\*{4}([^*]+)\\*{4}", "**$1**")
    text = F.regexp_replace(text, "(?U)\\*\\*\\s*([^*]+?)\\s*\\*\\*", "**$1**")
    text = F.regexp_replace(text, "\\*{3,}", "******")
    return F.regexp_replace(text, "(?U)।।\\s*([०-९\\d]+)\\s*।।", "।। $1 ।।")


def without_bold(c: Column) -> Column:
    return F.replace(c, F.lit("**"), F.lit(""))


FENCE = "```"


def fenced_lines(c: Column) -> Column:
    """If the text starts with a fence: the lines inside fences, the fence lines dropped."""
    # cut at fence lines, every second part stands inside
    parts = F.split(F.concat(c, F.lit("\n")), f"(?mdU)^[\\s&&[^\\n]]*{FENCE}[^\\n]*\\n")
    inside = F.array_join(F.filter(parts, lambda _, i: i % 2 == 1), "")
    return F.when(F.startswith(strip(c), F.lit(FENCE)), F.regexp_replace(inside, "\\n\\z", "")).otherwise(c)


def outer_fence(c: Column) -> Column:
    """Without the first opening and the last closing fence."""
    text = F.regexp_replace(strip(c), f"^{FENCE}[A-Za-z]*[ \\t]*\\n", "")
    return strip(F.regexp_replace(text, f"\\n{FENCE}[ \\t]*$", ""))


def first_last_fence(c: Column) -> Column:
    """Without a first and a last line that are fences."""
    lines = F.split(strip(c), "\n")
    lines = F.when(F.startswith(F.get(lines, F.lit(0)), F.lit(FENCE)), F.slice(lines, F.lit(2), F.size(lines))).otherwise(lines)
    lines = F.when((F.size(lines) > 0) & (strip(F.get(lines, F.size(lines) - 1)) == FENCE), F.slice(lines, F.lit(1), F.size(lines) - 1)).otherwise(lines)
    return F.array_join(lines, "\n")


def markdown_fence(c: Column) -> Column:
    """Without a wrapper marked as markdown; other fences stay."""
    pattern = f"(?s)^{FENCE}(?:markdown|md)[ \\t]*\\n(.*?)\\n?{FENCE}$"
    text = strip(c)
    return F.when(text.rlike(pattern), strip(F.regexp_extract(text, pattern, 1))).otherwise(text)


def repaired_json(c: Column) -> Column:
    """Single backslashes inside the values of ``"regex"`` keys doubled."""
    key = '"regex"\\s*:\\s*"'
    parts = F.split(c, f"(?={key})")

    def fix(part: Column) -> Column:
        value = F.regexp_extract(part, key + '((?:[^"\\\\]|\\\\.)*)', 1)
        rest = F.regexp_replace(part, f'^{key}(?:[^"\\\\]|\\\\.)*', "")
        return F.concat(F.regexp_extract(part, f"^{key}", 0), F.regexp_replace(value, "(?<!\\\\)\\\\(?!\\\\)", "\\\\\\\\"), rest)

    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike(f"^{key}"), fix(x)).otherwise(x)), "")


def parsed_json(c: Column, repair: bool = True) -> Column:
    """Struct (status, value): fences off, parsed as it is ("ok"), else repaired ("repaired"), else "error"."""
    text = fenced_lines(strip(c))
    plain = F.try_parse_json(text)
    fixed = F.try_parse_json(repaired_json(text)) if repair else F.lit(None).cast("variant")
    status = F.when(plain.isNotNull(), "ok").when(fixed.isNotNull(), "repaired").otherwise("error")
    return F.struct(status.alias("status"), F.coalesce(plain, fixed).alias("value"))


def json_block(c: Column) -> Column:
    """The first ``json`` fence's content, else the whole text, stripped."""
    pattern = f"(?s){FENCE}json\\s*\\n(.*?)\\n?{FENCE}"
    return strip(F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1)).otherwise(c))


def json_braces(c: Column) -> Column:
    """From the first to the last brace; null without."""
    found = F.regexp_extract(c, "(?s)\\{.*\\}", 0)
    return F.when(found != "", found)


def sampled(c: Column, most: int = 500_000, first: int = 102_400, middle: int = 51_200, last: int = 51_200, mark: str = "\n\n[...]\n\n") -> Column:
    """Struct (text, sampled): longer texts as their head, centre and tail with marks between."""
    if min(most, first, middle, last) < 0 or first + middle + last > most:
        raise ValueError("sizes are not negative and fit together in the most")
    n = F.length(c)
    begin = F.floor((n - middle) / 2).cast("int") + 1
    parts = F.concat(F.substring(c, F.lit(1), F.lit(first)), F.lit(mark), F.substring(c, begin, F.lit(middle)), F.lit(mark), F.substring(c, n - last + 1, F.lit(last)) if last else F.lit(""))
    return F.struct(F.when(n > most, parts).otherwise(c).alias("text"), (n > most).alias("sampled"))


def script_blocks(c: Column) -> Column:
    """Map script → text of its last block; without any block the text less comments as the first script."""
    entries = F.filter(
        F.array(*[
            F.struct(F.lit(s).alias("k"), _last(F.regexp_extract_all(c, F.lit(f"(?s)<!--\\s*sanskrit:{s}\\s*-->(.*?)<!-- /sanskrit:{s} -->"), F.lit(1))).alias("v"))
            for s in SCRIPTS
        ]),
        lambda e: e["v"].isNotNull(),
    )
    rest = strip(F.regexp_replace(c, "(?s)<!--.*?-->", ""))
    return F.when(F.size(entries) > 0, F.map_from_entries(entries)).otherwise(F.create_map(F.lit(SCRIPTS[0]), rest))


def _last(found: Column) -> Column:
    return strip(F.get(found, F.size(found) - 1))


def prompt(template: Column, values: Column) -> Column:
    """``{name}`` filled from a map; null if a name has no value."""
    names = F.array_distinct(F.regexp_extract_all(template, F.lit("\\{(\\w+)\\}"), F.lit(1)))
    text = F.aggregate(names, template, lambda t, n: F.replace(t, F.concat(F.lit("{"), n, F.lit("}")), F.try_element_at(values, n)))
    return F.when(~F.exists(names, lambda n: ~F.array_contains(F.map_keys(values), n)), text)
