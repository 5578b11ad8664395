"""Token ids: the encoder against the library, exact round trips."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from weblode.llm import op01_repair as op
from weblode.llm import pretokens
from weblode.llm.common import scratch_dir
from weblode.llm.pretokens import Encoder

PIECES = ["a", "b", "S", "'", "'s", "'re", "'ll", " ", "  ", "\n", "\t", "1", "é", "!", "日", "٣", "<|endoftext|>", "don't ", "\r\n", "🙂", "x've"]


@pytest.fixture(scope="module")
def coder():
    return Encoder(op.tokenizer_path())


def test_encoder_equals_the_library(coder):
    assert coder.plain
    rng = random.Random(7)
    for _ in range(400):
        texts = ["".join(rng.choices(PIECES, k=rng.randrange(12))) for _ in range(rng.randrange(5))]
        ids, counts = coder.encode(texts)
        expected = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == [i for e in expected for i in e]
        assert counts.tolist() == [len(e) for e in expected]


def test_grammar_round_trip():
    rng = np.random.default_rng(1)
    for vocabulary, sizes in ((5, [400, 1, 7]), (50, [3000]), (3, [1] * 9), (4, [5000, 2])):
        parts = [np.append(rng.integers(0, vocabulary, n - 1), op.END) for n in sizes]
        parts[0][: len(parts[0]) // 2] = 4  # a long run
        parts[0][-1] = op.END
        ids = np.concatenate(parts)
        g = op.compress(ids, np.array(sizes), 60)
        assert (op.expand(g.symbols, g.base, g.rules, g.lengths) == ids).all()
        for k in range(len(sizes)):
            own = op.expand(g.symbols[g.bounds[k] : g.bounds[k + 1]], g.base, g.rules, g.lengths)
            assert (own == parts[k]).all()
    assert len(g.rules) and len(g.symbols) < len(ids) / 2


def brute(coder, rows):
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*coder.tokenizer.encode(text or "", add_special_tokens=False).ids, op.END], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files(spark, coder):
    rows = [(k, f"some text {k % 7} " * (k % 50)) for k in range(60)]
    rows += [(None, "no id"), (3, ""), (3, None), (900, "long " * 30_000), (901, "same"), (901, "same")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string")
    out = scratch_dir(spark)
    op.write_tokens(df.repartition(3), out, op.tokenizer_path())
    got = [tuple(r) for r in op.read_digests(spark, out).collect()]
    assert sorted(got, key=lambda r: r[1]) == brute(coder, rows)
    full = sorted(op.read_tokens(spark, out).collect(), key=lambda r: r["start"])
    every = np.concatenate([r["ids"] for r in full])
    for start, n in ((0, 5), (17, 400), (len(every) - 3, 3), (5, 0)):
        assert (op.read_ids(spark, out, start, n) == every[start : start + n]).all()


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert op.write_and_read(spark, empty, op.tokenizer_path()).count() == 0


def test_settings_of_the_session_stay(spark, tmp_path):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, "777")
    try:
        df = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
        op.write_tokens(df, f"{tmp_path}/t", op.tokenizer_path())
        assert op.read_digests(spark, f"{tmp_path}/t").count() == 2 and spark.conf.get(key) == "777"
    finally:
        spark.conf.unset(key)


def test_frequent_keys_against_counts():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5, 400):
        key = rng.integers(0, 30, n)
        values, counts = np.unique(key, return_counts=True)
        for least in (1, 2, 12):
            got = op._frequent(key, least)
            assert np.array_equal(got[0], values[counts >= least]) and np.array_equal(got[1], counts[counts >= least])


def test_remembered_pieces_stay_bounded_and_frequent_ones_known(monkeypatch):
    monkeypatch.setattr(pretokens, "REMEMBERED", 200)
    coder = Encoder(op.tokenizer_path())
    coded, code = [], coder._coded
    monkeypatch.setattr(coder, "_coded", lambda texts: coded.extend(texts) or code(texts))
    common, rng = "the same words in every text", random.Random(2)
    for _ in range(60):
        texts = [common, " ".join("".join(rng.choices("abcdefgh", k=8)) for _ in range(20))]
        ids, counts = coder.encode(texts)
        expected = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == [i for e in expected for i in e] and counts.tolist() == [len(e) for e in expected]
        assert len(coder.known) <= 200 + 100
    assert coded.count(" same") == 1


def test_long_texts_take_little_memory(coder):
    rng = random.Random(5)
    texts = [" ".join(str(rng.randrange(10**9)) for _ in range(3000)) for _ in range(20)]
    rows = pa.RecordBatch.from_pydict({"key": list(range(120)), "text": texts * 6})
    list(op._shards(op.tokenizer_path(), op.END)(iter([rows.slice(0, 20)])))
    tracemalloc.start()
    list(op._shards(op.tokenizer_path(), op.END)(iter([rows])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
