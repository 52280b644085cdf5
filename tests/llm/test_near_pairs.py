"""Near-duplicate pairs of whole documents (q17, q19, q20) against plain Python."""

import random
import re
from collections import Counter
from difflib import SequenceMatcher

import pytest

from scriptorium.operators import align
from scriptorium.llm import queries

WORDS = [a + b for a in "ba ko ri tu se la mo ni".split() for b in "lan der vik som tep rus".split()]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(rng, t, k):
    words = t.split()
    for at in rng.sample(range(len(words)), k):
        words[at] = "changed"
    return " ".join(words)


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(5)
    base = [text(rng, n) for n in (30, 400, 3000)]
    rows = [*base, *[edited(rng, t, max(1, len(t.split()) // 200)) for t in base], base[1], text(rng, 500), None, ""]
    return list(enumerate(rows))


@pytest.fixture(scope="module")
def pairs(documents):
    """{document: representative} by comparing every two documents."""
    def shingles(t):
        w = re.findall("[^ \t-\r]+", (t or "").lower())
        return {tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))} if w else set()

    sets = {i: shingles(t) for i, t in documents}
    least = {i: i for i, _ in documents}
    for _ in documents:
        for i in sets:
            for j in sets:
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    least[i] = least[j] = min(least[i], least[j])
    return {i: k for i, k in least.items() if i != k}


@pytest.fixture(scope="module")
def folder(spark, documents, tmp_path_factory):
    path = tmp_path_factory.mktemp("near")
    spark.createDataFrame(documents, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_pairs_and_records(spark, documents, pairs, folder):
    texts = dict(documents)
    assert {r["pair_id"]: r["other_id"] for r in queries._near_pairs(spark, folder).collect()} == pairs
    assert set(pairs) >= {4, 5, 6}  # longer than a thousand characters
    want = Counter()
    for i, k in pairs.items():
        for seq, (op, a, b, c, d) in enumerate(SequenceMatcher(None, texts[i], texts[k], autojunk=False).get_opcodes()):
            if op != "equal":
                want[i, seq, texts[i][a:b], texts[k][c:d], a] += 1
    got = Counter((r["pair_id"], r["seq"], r["before"], r["after"], r["position"]) for r in queries.q17_diff_records(spark, folder).collect())
    assert got == want
    assert {r["pair_id"] for r in queries.q20_diff_report(spark, folder).where("pair_id IS NOT NULL").collect()} == set(pairs)
    assert {r["pair_id"]: (r["success"], r["restored"]) for r in queries.q19_word_repair(spark, folder).collect()} == {i: (True, True) for i in pairs}


def test_rows_without_and_with_one_identifier(spark, tmp_path):
    """Null and repeated identifiers: every row pairs by its own text, repeated rows once."""
    rng = random.Random(9)
    a, b = text(rng, 300), text(rng, 300)
    rows = [(1, a), (None, edited(rng, a, 1)), (2, b), (2, edited(rng, b, 1)), (2, "quite another text of this identifier"), (None, None), (3, b), (3, b)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter((r["pair_id"], r["source_text"], r["output_text"], r["other_id"]) for r in queries._near_pairs(spark, str(tmp_path)).collect())
    assert {k[0] for k in got} == {None, 2, 3} and set(got.values()) == {1} and len(got) == 3
    assert (None, rows[1][1], a, 1) in got and {k[3] for k in got if k[0] is not None} == {2}


def test_matcher_is_difflib():
    rng = random.Random(1)
    for n in (0, 1, 7, 60, 300, 900):
        for letters in ("ab", "abcdefgh "):
            a = "".join(rng.choice(letters) for _ in range(n))
            b = a[: n // 3] + "".join(rng.choice(letters) for _ in range(n // 5)) + a[n // 2 :]
            for x, y in ((a, b), (b, a), (a, a[::-1]), (a.split(), b.split())):
                assert align.Matcher(x, y).get_opcodes() == SequenceMatcher(None, x, y, autojunk=False).get_opcodes()


def test_texts_are_shuffled_only_for_classes(spark, folder, monkeypatch):
    """The search reads the table as it lies, and texts go on only from classes of several rows."""
    seen, near, write = [], queries.near_duplicates, queries.written

    def search(docs, **options):
        seen.append(docs._jdf.queryExecution().executedPlan().toString())
        return near(docs, **options)

    kept = []
    monkeypatch.setattr(queries, "near_duplicates", search)
    monkeypatch.setattr(queries, "written", lambda df, label: kept.append((label, out := write(df, label))) or out)
    rows = queries._near_pairs(spark, folder)
    assert len(seen) == 1 and "Exchange" not in seen[0]
    texts = dict(kept)["near-texts"]
    assert texts.count() == rows.count() + rows.select("other_id").distinct().count()
