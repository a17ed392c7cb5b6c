"""The pipeline, stage by stage, against plain versions of the stages."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
import corpus_pipeline
from tidegauge.llm.queries import vocabulary


def test_stages(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(5)
    rows = [(d, t) for d, t in cases.rows() if d not in (400, 401)]
    bad = [(2000 + i, cases.prose(rng, 40) + " grumpf" + rng.choice(cases.WORDS) + " grumpfant " + cases.prose(rng, 40)) for i in range(90)]
    clean = [(3000 + i, cases.prose(rng, 60)) for i in range(150)]
    docs = cases.documents(spark, rows + bad + clean)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(d, 1) for d, _ in bad] + [(d, 0) for d, _ in clean]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    found, current = {}, spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, current, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        found[name] = current = spark.read.parquet(str(tmp_path / name))
    text = {name: [(r.doc_id, r.text) for r in df.collect()] for name, df in found.items() if name != "packing"}

    left = Counter(d for d, _ in text["toxicity"])
    assert sum(left[d] for d, _ in bad) <= 9 and sum(left[d] for d, _ in clean) >= 143
    exact = Counter(d for d, _ in text["exact_dedup"])
    assert exact == Counter(d for (d, _, _, kept, _), n in cases.exact(text["toxicity"]).items() for _ in range(n) if kept)
    components = {c for (_, _, c) in cases.simhash(text["exact_dedup"], least=0.8)}
    # Two ids name two texts each, so components may share the id that names them.
    assert {d for d, _ in text["simhash_dedup"]} >= components and 0 <= len(text["simhash_dedup"]) - len(components) <= 2
    before, after = Counter(text["simhash_dedup"]), Counter(text["pii"])
    assert {d for d, _ in (after - before)} == {600, 601} and sum(after.values()) == sum(before.values())
    plain = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    pieces = found["packing"].collect()
    for doc_id, words in text["pii"]:
        ids = np.array([*plain.encode(words or "", add_special_tokens=False).ids, 1], dtype="<u4")
        assert any(r.doc_id == doc_id and r.doc_tokens == len(ids) and zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in pieces)
    assert corpus_pipeline.run(spark, str(tmp_path)).agg(F.sum("length")).first()[0] == sum(r.length for r in pieces)


ODD = ("score", "_row", "number", "print", "bytes", "root", "ids", "file", "part", "label", "kept", "keep_id")


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_odd_rows_and_columns(spark, tmp_path, rows):
    """Nulls in every column, empty and long texts, repeated rows, columns of clashing names, no labels; and no rows at all."""
    rng = random.Random(8)
    long = cases.prose(rng, 30_000)
    some = [(None, None), (None, ""), (1, ""), (2, " \t\n"), (3, long), (4, long.upper()), (5, long + " and one word more"), (6, "a b c"), (6, "a b c"), (7, "x"), (None, "no id"), (8, cases.prose(rng, 40))]
    docs = cases.documents(spark, some if rows == "odd" else [])
    docs = docs.withColumns({name: F.lit(f"own {name}") for name in ODD} | {"lang": F.lit(None).cast("string")})
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))

    found, current = {}, spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, current, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        found[name] = current = spark.read.parquet(str(tmp_path / name))
        if name != "packing" and rows == "odd":
            assert all(current.filter(F.col(f"`{own}`") != f"own {own}").isEmpty() for own in ODD)
    if rows == "none":
        assert all(df.isEmpty() for df in found.values())
        return
    ids = {name: sorted((r.doc_id or 0 for r in df.select("doc_id").collect())) for name, df in found.items() if name != "packing"}
    assert ids["toxicity"] == sorted(d or 0 for d, _ in some)  # nothing to learn from
    assert ids["exact_dedup"] == [0, 1, 2, 4, 5, 6, 7, 8]  # empty and null texts are equal, as are long texts but for case
    # Texts without words are near copies of each other, and so are the two long ones.
    assert ids["simhash_dedup"] == ids["pii"] == [0, 1, 4, 6, 7, 8]
    whole = {r.doc_id or 0: r for r in found["packing"].groupBy("doc_id").agg(F.sum("length").alias("length"), F.max("doc_tokens").alias("tokens")).collect()}
    assert sorted(whole) == ids["pii"] and all(r.length == r.tokens for r in whole.values()) and whole[1].tokens == 1
