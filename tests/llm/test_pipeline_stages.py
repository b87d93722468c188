from __future__ import annotations

import time
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from buyerlens.llm import budget_mix, encoding, hamming_dedup, positional_index, quality_divergence, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, key long, size long"
PASSAGE = " ".join(f"Leaked{i}" for i in range(14))


def test_stages_and_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "near-dedup", "decontamination", "source mix", "token ids"]
    assert sorted(queries.QUERIES) == sorted(["pipeline", *(n for n in queries.QUERIES if n.startswith("op"))]) and len(queries.QUERIES) == 14


def _prose(i: int, n: int = 40) -> str:
    return " ".join(f"w{(i * 131 + j * j * 17) % 9973}" for j in range(n))


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Clean documents, copies, near copies, a leak, nulls, empty texts, repeated rows and columns with taken names."""
    folder = tmp_path_factory.mktemp("corpus")
    rows = [(i, _prose(i), "en", f"s{i % 3}", 1) for i in range(30)]
    rows += [(100 + i, _prose(0), "en", "s0", 1) for i in range(3)]
    rows += [(200, _prose(1) + " more", "en", "s1", 1), (300, f"{_prose(50)} {PASSAGE}", "en", "s2", 1)]
    rows += [(400, None, "en", "s0", 1), (401, "", None, None, None), (402, "too short", "en", "s0", 1), (403, _prose(60), None, None, None)]
    rows += [rows[5], (None, _prose(70), "en", "s0", 1), (500, "<|endoftext|> " + _prose(80), "en", "s1", 1)]
    rows = [(*r, True, 7, 9) for r in rows]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([("b0", PASSAGE.lower()), ("b1", None), ("b2", "")], "item_id string, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return str(folder)


def test_the_chain(spark, sf_dir):
    """The stages one by one, each decision against a plain version, then the chain as a whole."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = corpus_pipeline.quality(spark, docs, sf_dir)
    assert good.columns == docs.columns
    bad = {r.doc_id for r in quality_divergence.divergence_report(docs).where("not kept").collect()}
    assert Counter(r.doc_id for r in good.collect()) == Counter(r.doc_id for r in docs.collect() if r.doc_id not in bad) and {400, 401, 402} <= bad

    good = spark.createDataFrame(good.collect(), good.schema)
    single = corpus_pipeline.near_dedup(spark, good, sf_dir)
    left = Counter(r.doc_id for r in single.collect())
    dropped = {r.doc_id for r in good.collect()} - set(left)
    assert dropped == {100, 101, 102, 200} and single.columns == docs.columns and left[5] == 2 and left[None] == 1

    single = spark.createDataFrame(single.collect(), single.schema)
    clean = corpus_pipeline.decontamination(spark, single, sf_dir)
    assert Counter(r.doc_id for r in clean.collect()) == Counter({k: v for k, v in left.items() if k != 300})

    clean = spark.createDataFrame(clean.collect(), clean.schema)
    mixed = corpus_pipeline.mixing(spark, clean, sf_dir)
    words = sum(len((r.text or "").split()) for r in clean.collect())
    taken = sum(len((r.text or "").split()) for r in mixed.collect())
    assert abs(taken - words) <= 0.1 * words and mixed.columns == docs.columns

    mixed = spark.createDataFrame(mixed.collect(), mixed.schema)
    rows = corpus_pipeline.token_ids(spark, mixed, sf_dir).collect()
    want = _ids(mixed)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    assert sum(r.n_tokens for r in rows) == max(r.start + r.n_tokens for r in rows)
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in whole) == want


def _shuffles(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name.split("_")[1] for name in names if name.startswith("shuffle_")}


def test_stages_leave_no_shuffle_files(spark, sf_dir):
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = _shuffles(spark)
        kept.append(stage(spark, docs, sf_dir))
        until = time.monotonic() + 5
        while (left := _shuffles(spark) - before) and time.monotonic() < until:
            time.sleep(0.1)
        assert not left, f"{name} left {len(left)} shuffles"
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def _ids(docs) -> Counter:
    from tokenizers import Tokenizer

    tokenizer, out = Tokenizer.from_file(encoding.vocabulary_path()), Counter()
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        out[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    return out


def test_an_empty_corpus(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert hamming_dedup.near_duplicates(docs).count() == budget_mix.mix_report(docs).count() == 0
    assert positional_index.contamination(docs, spark.read.parquet(f"{tmp_path}/benchmark.parquet")).count() == 0
