"""What a worker holds between maps: a tokenizer goes when another map begins, Arrow's unused memory after each."""

import gc
import weakref

import pyarrow as pa

from scriptorium.llm import exact_dedup, kernels, minhash_dedup, packing, toxicity
from scriptorium.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def rows(*columns):
    return iter([pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[f"c{k}" for k in range(len(columns))])])


def test_the_tokenizer_goes_with_the_next_map():
    maps = {
        "signatures": lambda: minhash_dedup._signatures(3, 4)(rows([1], [1], [b"one two three four"])),
        "toxicity": lambda: toxicity._features(toxicity.Signs({}, {}, frozenset()), [])(rows([1], [1], ["one two"], pa.nulls(1, pa.int32()))),
    }
    for name, other in maps.items():
        first = packing.word_tokenizer(PATH)
        assert packing.word_tokenizer(PATH) is first
        gone = weakref.ref(first)
        del first
        assert sum(x.num_rows for x in other()) == 1
        gc.collect()
        assert gone() is None, name


def test_unused_memory_is_given_back_even_after_a_break(monkeypatch):
    calls = []

    class Pool:
        def release_unused(self):
            calls.append(1)

    monkeypatch.setattr(kernels.pa, "default_memory_pool", Pool)
    kept = kernels.kept("a", object)
    some = kernels.lean(lambda batches: iter([1, 2]), keeps=True)
    assert list(some(iter(()))) == [1, 2] and calls == [1]
    assert kernels.kept("a", object) is kept
    stopped = some(iter(()))
    next(stopped)
    stopped.close()
    assert calls == [1, 1]
    assert list(kernels.lean(lambda batches: iter([]))(iter(()))) == [] and kernels.kept("a", object) is not kept
    assert exact_dedup._combine(1, True, 1 << 20).__wrapped__
