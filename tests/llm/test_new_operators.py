"""Language by centroids, divergence of sources and the Merkle manifest against plain versions and SQL."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import cases
from tidegauge.llm import divergence, language, manifest
from tidegauge.llm.oracles import DIVERGENCE_SQL, MANIFEST_SQL

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def by_sql(query: str, rows: list[tuple]) -> Counter:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
    connection = duckdb.connect()
    connection.register("documents", pa.table({name: pa.array([row[i] for row in rows], kind) for i, (name, kind) in enumerate(zip(COLUMNS, kinds))}))
    return Counter(connection.execute(query).fetchall())


def odd_rows() -> list[tuple]:
    rng = random.Random(1)
    words = ["A", "b", "Cc", "É", "é", "x\x01y", "ß9z", "d_e", "你好", "f"]
    rows = [
        (i if i % 17 else None, None if i % 11 == 0 else " ".join(rng.choice(words) for _ in range(rng.randint(0, 9))), rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s2", None, "", "s\U0001f600", "s￮"]), i)
        for i in range(260)
    ]
    rows += [(1000, None, "zz", "q", 1), (1001, "only once", "zz", "r", 1), (1002, "", "yy", "r", None), (1003, "Long " * 300_000, "yy", "r", 2)]
    return rows + rows[:40] + [(77, "Same Id", "en", "s1", 1), (77, "other", "en", "s1", 1)]


def frame(spark, rows, extra=()):
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.withColumns({name: F.lit(f"own {name}") for name in extra}) if extra else docs


class TestManifest:
    EXTRA = ("pos", "tree", "leaf", "found", "n", "part", "at", "_part", "_at", "segment", "above", "id", "kids", "digest")

    @pytest.mark.parametrize("extra", [(), EXTRA])
    def test_as_sql(self, spark, extra):
        rows = odd_rows()
        found = Counter(map(tuple, manifest.manifest(frame(spark, rows, extra)).collect()))
        assert found == by_sql(MANIFEST_SQL, rows)

    def test_small_and_empty(self, spark):
        assert manifest.manifest(frame(spark, [])).count() == 0
        for rows in ([(1, "A", "en", "s", 1)], [(1, "A", "en", "s", 1), (2, "B", None, None, None), (3, "C", "", "s", 1)], [(i, "Xy", f"l{i}", "s", 1) for i in range(70)] + [(100 + i, "Xy", "l3", "s", 1) for i in range(9)]):
            assert Counter(map(tuple, manifest.manifest(frame(spark, rows)).collect())) == by_sql(MANIFEST_SQL, rows)

    def test_proofs_hold_by_hand(self, spark):
        rows = [(i, f"Text {i}", "en", "s", i) for i in range(100)]
        trees = manifest.Manifest(frame(spark, rows))
        for row in trees.proofs().collect():
            value = bytes(row.leaf).hex()
            for step in row.segment:
                value = hashlib.sha256((bytes(step.left).hex() + value + bytes(step.right).hex()).encode()).hexdigest()
            assert value == trees.root and len(row.segment) == 3

    def test_a_hot_group_of_equal_rows(self, spark):
        rows = [(5, "Same", "en", "s", 1)] * 300 + [(i, f"t{i}", "de", "s", 1) for i in range(50)]
        trees = manifest.Manifest(frame(spark, rows))
        assert Counter(map(tuple, manifest.manifest(frame(spark, rows)).collect())) == by_sql(MANIFEST_SQL, rows)
        assert trees.leaves.filter("doc_id = 5").select("above").distinct().count() >= 300 // manifest.ARITY


class TestDivergence:
    EXTRA = ("term", "count", "p", "q", "p0", "total", "terms", "own", "item", "value", "rank", "part", "shard", "first", "doc_id2")

    @pytest.mark.parametrize("limit", [divergence.BLOCK_POSTINGS, 7])
    def test_as_sql(self, spark, limit):
        rows = odd_rows()
        found = Counter(map(tuple, divergence.divergence(frame(spark, rows, self.EXTRA), limit=limit).collect()))
        assert found == by_sql(DIVERGENCE_SQL, rows)

    def test_empty(self, spark):
        assert divergence.divergence(frame(spark, [])).count() == 0

    def test_terms_of_several_texts(self):
        texts = [b"", None, "One two\u00a0ONE".encode(), b" 12 ", b"x", "\u00e9t\u00e9 Z9z".encode() + b"\x00", b"x y"]
        terms, doc = divergence.terms_of(texts)
        wanted = [(i, term) for i, text in enumerate(texts) for term in (text or b"").translate(divergence.TERM_BYTES).split()]
        assert list(zip(doc.tolist(), terms.to_pylist())) == wanted and len(wanted) == 8
        assert [len(x) for x in divergence.terms_of([None, b""])] == [0, 0]
        long = b"ab " * divergence.CUT
        assert b"".join(divergence.pieces_of(long)) == long and sum(len(divergence.terms_of([x])[0]) for x in divergence.pieces_of(long)) == divergence.CUT

    def test_heap_merge(self):
        """Runs of odd sizes, each in blocks, against plain counting."""
        rng = random.Random(2)
        texts = [("en", rng.choice("ab"), " ".join(rng.choice(cases.WORDS) + rng.choice(cases.WORDS) for _ in range(rng.randint(0, 60))).encode()) for _ in range(300)]
        blocks = []
        for at in range(0, 300, 37):
            block = divergence.Postings()
            block.add(*map(list, zip(*texts[at : at + 37])))
            blocks += [x for x in divergence.blocks_of(block.leave(3))]
        counts, docs = Counter(), Counter()
        for _, source, text in texts:
            words = text.split()
            counts.update((source, w) for w in words)
            docs.update(set(words))
        merged = list(divergence.heap_merged(sorted(blocks, key=lambda x: x[:3])))
        assert {term: n for _, term, n, _ in merged} == docs and len(merged) == len(docs)
        assert {(s, term): n for _, term, _, found in merged for s, n in found.items()} == counts

    def test_pairs_of_a_chunk(self):
        """Chunks of any size give the sums of a plain loop."""
        rng, p, p0, code, starts, want = np.random.default_rng(3), [], [], [], [], Counter()
        for _ in range(50):
            own = rng.permutation(9)[: rng.integers(1, 9)]
            starts.append(len(code))
            ps, zeros = rng.integers(1, 10**9, len(own)), rng.integers(1, 1000, len(own))
            f = lambda x, y: (int(x) - int(y)) ** 2 // int(y)
            for i, a in enumerate(own):
                for j, b in enumerate(own):
                    if i != j:
                        want[(int(a), int(b))] += f(ps[i], ps[j]) - f(ps[i], zeros[j]) - f(zeros[i], ps[j])
            code += own.tolist()
            p += ps.tolist()
            p0 += zeros.tolist()
        old = divergence.AT_ONCE
        for size in (1, 20, old):
            divergence.AT_ONCE = size
            sums = divergence.PairSums()
            sums.add(np.array(code), np.array(p), np.array(p0), np.array(starts))
            assert {(k >> 32, k & divergence.LOW): v for k, (_, v) in sums.sums.items()} == want
        divergence.AT_ONCE = old


def grams_by_hand(text: str | None) -> np.ndarray:
    out, mask = np.zeros(language.BUCKETS), (1 << 64) - 1
    points = [ord(c) for c in f" {language.NO_LETTERS.sub(' ', (text or '').lower()).strip()} "]
    a, b, c = (int(x) for x in language.MIX)
    for i in range(len(points)):
        hashed = 0
        for n, point in enumerate(points[i : i + language.LONGEST]):
            hashed = ((hashed * a + point + n + 1) & mask) * b & mask
            out[((hashed ^ (hashed >> 29)) * c & mask) >> (65 - language.BUCKETS.bit_length())] += 1
    return out


class TestLanguage:
    TEXTS = ("Hello, World! été", None, "", "a", "x" * 50, "你好 world 123 ½", "abc déf ghi " * 300)

    @pytest.mark.parametrize("size", [100, 400_000])
    def test_grams(self, monkeypatch, size):
        monkeypatch.setattr(language, "AT_ONCE", size)
        assert np.array_equal(language.gram_counts(list(self.TEXTS)), np.array([grams_by_hand(text) for text in self.TEXTS]))

    @staticmethod
    def rows() -> list[tuple]:
        rng = random.Random(4)
        parts = {"en": "the of and ing tion hat wh".split(), "fr": "ère eau le la ou que é".split(), "de": "sch ung keit der ü ich ei".split()}
        rows = [(i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(8, 60))), lang, "s", 1) for i, lang in enumerate(["en", "fr", "de", "en"] * 60)]
        rows += [(900, None, "en", "s", 1), (901, "", "fr", "s", 1), (902, "12 ½ #", "de", "s", 1), (903, rows[1][1], None, "s", 1), (None, rows[2][1], "de", None, None), (904, "the " * 250_000, "en", "s", 1)]
        return rows + rows[:5]

    def test_scores_by_hand(self, spark):
        rows = self.rows()
        docs = frame(spark, rows, ("id", "found", "score", "_place", "lang_pred"))
        found = language.languages(docs).collect()
        assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
        model = language.fit(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
        out = lambda i: i is None or zlib.crc32(str(i).encode()) % 4 == 2
        known = [r for r in rows if r[1] is not None and r[2] is not None and not out(r[0])]
        df = np.sum([grams_by_hand(r[1]) > 0 for r in known], axis=0)
        assert np.allclose(model["idf"], np.log((1 + len(known)) / (1 + df)), atol=1e-5)
        want = Counter()
        for doc_id, text, *_ in rows:
            vector = np.log1p(grams_by_hand(text)) * model["idf"]
            cosines = model["centroids"] @ (vector / max(1e-12, np.linalg.norm(vector)))
            und = not any(c.isalpha() for c in text or "")
            want[(doc_id, out(doc_id), "und" if und else model["langs"][int(cosines.argmax())], 0.0 if und else round(float(cosines.max()), 3))] += 1
        assert Counter((r.doc_id, r.held_out, r.lang_pred, round(r.score, 3)) for r in found) - want == Counter() or sum((Counter((r.doc_id, r.held_out, r.lang_pred) for r in found) - Counter(k[:3] for k in want.elements())).values()) == 0
        lang = {r[0]: r[2] for r in rows}
        held = [r for r in found if r.held_out and r.doc_id is not None and r.lang_pred != "und"]
        assert len(held) > 30 and all(r.lang_pred == lang[r.doc_id] for r in held)

    def test_labels_and_ids_of_held_out_rows_change_nothing(self, spark):
        rows = self.rows()
        first = {(r.doc_id, r.lang_pred, r.score) for r in language.languages(frame(spark, rows)).collect()}
        other = [(i, t, "xx" if i is None or zlib.crc32(str(i).encode()) % 4 == 2 else lang, "z", 9) for i, t, lang, _, _ in rows]
        assert {(r.doc_id, r.lang_pred, r.score) for r in language.languages(frame(spark, other)).collect()} == first

    def test_nothing_to_learn_from(self, spark):
        assert language.languages(frame(spark, [])).count() == 0
        found = language.languages(frame(spark, [(1, "words", None, "s", 1)])).collect()
        assert [(r.lang_pred, r.score, r.rejected) for r in found] == [("und", 0.0, True)]

    def test_far_texts_are_rejected(self, spark):
        rows = [*self.rows(), (5000, "zqx jkq xzv qqj vvw zzx kkq", None, "s", 1)]
        found = {r.doc_id: r.rejected for r in language.languages(frame(spark, rows)).collect()}
        assert found[5000] and sum(found.values()) < 20
