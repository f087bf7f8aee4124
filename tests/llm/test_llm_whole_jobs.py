"""Mixing and packing that must use all of their input, on small tables; and what
workers keep meanwhile."""

import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from scriptorium.llm import language_id, minhash, mixing, packing, queries, worker


def test_mixing_keeps_what_has_no_target(spark):
    rows = [(k, f"src{k % 3}" if k % 4 else ("web", None)[k % 8 == 0], ("en", "fr", "it", None)[k // 4 % 4], "lorem ipsum " * (3 + k % 5)) for k in range(160)]
    docs = mixing.measured(spark.createDataFrame(rows, "doc_id long, source string, lang string, text string"))
    found = mixing.mixed(docs, (queries.SOURCES, queries.LANGUAGES, queries.TOPIC_SHARES), queries.KEEP).collect()
    assert all(r["_probability"] > 0 for r in found)
    expected = lambda rest: sum(r["_tokens"] * r["_probability"] for r in rest) / sum(r["_tokens"] * r["_probability"] for r in found)
    share = lambda rest: sum(r["_tokens"] for r in rest) / sum(r["_tokens"] for r in found)
    for rest in ([r for r in found if r["lang"] not in queries.LANGUAGES], [r for r in found if r["source"] not in queries.SOURCES]):
        assert expected(rest) > 0.6 * share(rest)
    only = mixing.mixed(docs.filter("lang is null"), (queries.SOURCES, queries.LANGUAGES, queries.TOPIC_SHARES), queries.KEEP).collect()
    assert only and all(r["_probability"] > 0 for r in only)


def test_packer_takes_all_neighbours_before_unrelated_rows():
    seed = np.arange(2, 32, dtype=np.uint16)  # 30 terms, none better than another
    unrelated = [np.full(2, 40 + k % 8, np.uint16) for k in range(30)]
    like = [np.array([2 + k % 30, 2 + k % 30], np.uint16) for k in range(60)]  # a term of the seed's each
    pieces = packing.Packer([seed, *unrelated, *like], np.ones(64, np.float32), 3.0, 150).pack()
    assert {p[0] for p in pieces if p[3] == 0} == {0, *range(31, 91)}
    rng = np.random.default_rng(1)
    texts = [rng.choice(60, rng.integers(3, 30)).astype(np.uint16) for _ in range(300)]
    idf = rng.random(64).astype(np.float32) + 0.1
    packer = packing.Packer(texts, idf, 15.0, 64)
    weight = lambda t, x: idf[x] * (c := int((t == x).sum())) * (packing.K1 + 1) / (c + packing.K1 * (1 - packing.B + packing.B * len(t) / 15.0))
    score = [sum(weight(t, x) for x in set(texts[7].tolist()) & set(t.tolist())) for t in texts]
    ranked = list(packer.neighbours(7))
    assert set(ranked) == {k for k, s in enumerate(score) if s > 0 and k != 7}
    assert all(score[a] >= score[b] - 1e-4 for a, b in zip(ranked, ranked[1:]))


def test_steps_let_go_of_what_another_one_kept(spark):
    """Each Python worker of the pipeline's later stages had the scorer of the first beside its own objects."""
    docs = spark.createDataFrame([(k, k, f"eins zwei drei {k}", "de") for k in range(8)], "_row long, doc_id long, text string, lang string")
    model = language_id.train(docs.selectExpr("text", "lang", "0L as _draw"))

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([",".join(worker._held)])], ["held"])

    for step, wanted in ((lambda: language_id.identify(docs, model), "scorer"), (lambda: minhash.signed(docs, 4), ""), (lambda: mixing.measured(docs), ""), (lambda: packing.pack(docs), "tokenizer")):
        step().collect()
        kept = {r["held"].split(" ")[0] for r in docs.coalesce(1).select("_row").mapInArrow(held, "held string").collect()}
        assert kept <= {wanted, ""}


def test_cells_take_no_worker_of_their_own(spark, monkeypatch):
    """The table of chances went through plain Python workers, which stayed beside the Arrow ones."""
    docs = spark.createDataFrame([(1, "src0", "en", "lorem ipsum", 0, 2)], "doc_id long, source string, lang string, text string, _topic int, _tokens long").localCheckpoint()
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", lambda *_, **__: pytest.fail("rows in Python workers"))
    targets = (queries.SOURCES, queries.LANGUAGES, queries.TOPIC_SHARES)
    assert [r["doc_id"] for r in mixing.mixed(docs, targets, queries.KEEP).collect()] == [1]
    assert mixing.mixed(docs.limit(0), targets, queries.KEEP).collect() == []


FREED = r"""
import re
import pyarrow as pa
import pyarrow.compute as pc
from scriptorium.llm.worker import lean

def resident():
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", open("/proc/self/smaps_rollup").read()))) >> 10

def step(batches):
    for batch in batches:
        pieces = [bytes(700) for _ in range(200_000)]  # 140 MB that the C library keeps below the last one
        end = bytes(700)
        words = pc.utf8_split_whitespace(batch.column(0))
        del pieces, words
        yield batch
        del end

batch = pa.record_batch([pa.array(["a b c d " * 100] * 20_000)], ["text"])
before = resident()
for _ in lean(step)(iter([batch])):
    pass
print(resident() - before)
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists() or "glibc" not in "".join(__import__("platform").libc_ver()), reason="memory can't be read")
def test_a_step_hands_freed_memory_back():
    found = subprocess.run([sys.executable, "-c", FREED], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    assert int(found.stdout) < 40
