"""Every operator on a small table of odd cases against a plain version of it."""

import gzip
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from tidegauge.llm import components, exact, licenses, packing, pieces, pii, quality, sharding, similar, simhash, toxicity, warc
from tidegauge.llm.queries import vocabulary

ROWS = cases.rows()


def counted(df, *names) -> Counter:
    return Counter(tuple(row) for row in df.select(*names).collect())


@pytest.fixture(params=["documents", "with extra columns", "empty"])
def given(request, spark):
    """(table, its rows): as it is, with columns of clashing names, without rows."""
    some = [] if request.param == "empty" else ROWS
    docs = cases.documents(spark, some)
    return (cases.with_extra(docs) if request.param == "with extra columns" else docs), some


@pytest.fixture
def labels(spark):
    known = [(i, i % 5 > 0, 0) for i in range(60)] + [(None, 1, 1), (1, None, None), (2, 1, 0), (2, 1, 0)]
    return spark.createDataFrame([(i, None if q is None else int(q), t) for i, q, t in known], "doc_id long, quality int, toxic int")


def test_exact(given):
    docs, some = given
    assert counted(exact.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == cases.exact(some)


def test_exact_tells_colliding_fingerprints_apart(spark):
    docs = cases.documents(spark)
    found = exact.exact_groups(docs, primes=(2,))
    assert counted(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == cases.exact(ROWS)


def test_exact_keeps_whole_rows(given):
    docs, some = given
    kept = exact.without_copies(docs)
    assert kept.columns == docs.columns
    wanted = Counter((doc_id, sha) for (doc_id, _, _, stays, sha), n in cases.exact(some).items() for _ in range(n) if stays)
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert counted(kept.select("doc_id", F.sha2(lower, 256).alias("sha")), "doc_id", "sha") == wanted


def test_fingerprints_compose():
    of, rng = exact.Fingerprints(), random.Random(1)
    for _ in range(50):
        data, cut = rng.randbytes(rng.randint(0, 5000)), rng.randint(0, 3000)
        left, right = data[:cut], data[cut:]
        assert of.combine(of(left), of(right), len(right)) == of(data)
    assert of(b"") == (0, 0, 0) and of(b"\0") != of(b"") and of(b"a\0") != of(b"a")
    plain = [sum((b + 1) * pow(base, len(b"hello") - 1 - i, p) for i, b in enumerate(b"hello")) % p for base, p in zip(of.bases, of.primes)]
    assert list(of(b"hello")) == plain
    huge = rng.randbytes(3 * exact.HASHED + 777)
    for size in (exact.HASHED, exact.HASHED + 1, len(huge)):
        assert of(huge[:size]) == of._piece(huge[:size])
    assert exact.same_text("AÉ" * 100_000, "aÉ" * 100_000) and not exact.same_text("É", "é") and not exact.same_text("a", "ab")


def test_simhash(given):
    docs, some = given
    assert counted(simhash.simhash_components(docs), "doc_id", "fingerprint", "component_id") == cases.simhash(some)


def test_simhash_keeps_one_of_each(given):
    docs, some = given
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns
    alone = {c for (_, _, c) in cases.simhash(some, least=0.8)}
    assert {r.doc_id for r in kept.select("doc_id").collect()} >= alone
    assert kept.count() == len(alone)


@pytest.mark.parametrize("part", [4096, 5])
def test_links_connect_as_all_pairs_do(spark, part):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    prints = set(rng.integers(0, 2**63, 300, dtype=np.uint64).tolist())
    for centre in centres.tolist():
        for _ in range(12):
            for bit in rng.integers(0, 64, rng.integers(1, 4)).tolist():
                centre ^= 1 << bit
            prints.add(centre)
    prints = sorted(prints)
    table = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "print long")
    found = components.components(simhash.links(table, part=part)).collect()
    root = {row.node % 2**64: row.root % 2**64 for row in found}
    groups = defaultdict(set)
    for p in prints:
        groups[root.get(p, p)].add(p)
    label = {p: p for p in prints}

    def top(p):
        while label[p] != p:
            p = label[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 3:
                label[top(a)] = top(b)
    wanted = defaultdict(set)
    for p in prints:
        wanted[top(p)].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


@pytest.mark.parametrize("part", [1024, 4])
def test_similar_links_connect_as_all_pairs_do(spark, part):
    rng, passage = random.Random(12), cases.prose(random.Random(13), 60)
    texts = [cases.prose(rng, rng.randint(1, 80)) for _ in range(40)] + [None, "", " \n", "a b", "A  b", "a b c"]
    texts += [passage + " " + cases.prose(rng, rng.randint(5, 40)) for _ in range(40)]  # a passage that many share
    for text in texts[:30:3]:
        words = text.split(" ")
        for _ in range(8):  # chains of small edits
            words[rng.randrange(len(words))] = cases.prose(rng, 1)
            texts.append(" ".join(words))
    grown = cases.prose(rng, 150).split(" ")
    for n in range(150):  # a large group, not all of whose texts are like the first
        texts.append(" ".join(["new" if (i * 7 + n) % 150 < n % 5 else w for i, w in enumerate(grown)]))
    table = spark.createDataFrame(list(enumerate(texts)), "number long, text string").repartition(3)
    rows = table.select("number", "text", similar.sketched()(F.col("text")).alias("bands")).persist()
    found = {r.node: r.root for r in components.components(similar.similar_links(rows, part=part, part_hashes=2_000_000 if part > 4 else 500)).collect()}
    rows.unpersist()
    sets, label = [cases.shingles_of(text) for text in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and cases.alike(sets[i], sets[j], 0.8):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert [found.get(i, i) for i in range(len(texts))] == label


@pytest.mark.parametrize("size", [1, 4, 5, 9, 16, 60, 400])
def test_connected_loses_no_similar_pair(size):
    """Also pairs at a similarity of just 0.8, whose fingerprints may differ in any number of bits."""
    rng, sets = np.random.default_rng(size), []
    for _ in range(12):
        base = rng.choice(2**20, size, replace=False)
        sets.append(np.sort(base).astype(np.uint64))
        for _ in range(10):
            swapped = base.copy()
            some = rng.choice(size, size // 9 + int(rng.integers(0, 2)) if size > 1 else 0, replace=False)
            swapped[some] = rng.integers(2**20, 2**40, len(some))
            sets.append(np.sort(swapped).astype(np.uint64))
    whole = [set(x.tolist()) for x in sets]
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if label[a] != label[b] and 5 * len(whole[a] & whole[b]) >= 4 * len(whole[a] | whole[b]):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    found = list(range(len(sets)))
    for a, b in similar.connected(sets, np.arange(len(sets))):
        low, high = sorted((found[a], found[b]))
        found = [low if x == high else x for x in found]
    assert found == label


def test_tree_follows_only_edges_within_the_radius():
    prints = np.random.default_rng(2).integers(0, 2**63, 500, dtype=np.uint64)
    tree = simhash.BKTree(prints)
    assert all(np.bitwise_count(prints[child.node] ^ prints[tree.node]) == d for d, child in tree.children.items())
    queries = prints[:50] ^ np.uint64(0b101)
    found = {(node, int(q)) for node, hits in tree.near(queries, 3) for q in hits}
    assert found == {(n, q) for n in range(500) for q in range(50) if int(prints[n] ^ queries[q]).bit_count() <= 3}


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, i) for i in range(1001, 1300)] + [(-5, -4), (-4, -5), (7, 7)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r.node, r.root) for r in found} == {(i, 0) for i in range(1, 41)} | {(i, 1000) for i in range(1001, 1300)} | {(-4, -5)}


def test_packing(given):
    from tokenizers import Tokenizer

    docs, some = given
    plain = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    ids = {(d, t): [*plain.encode(t or "", add_special_tokens=False).ids, 1] for d, t in some}
    found = packing.pack(docs, vocabulary("byte_bpe_50k.json")).collect()
    of = defaultdict(list)
    for row in found:
        assert zlib.crc32(bytes(row.ids)) == row.ids_crc32 and len(row.ids) == 4 * row.length and 0 < row.length
        of[row.sequence_id].append(row)
    for number, members in of.items():
        members.sort(key=lambda r: r.offset)
        ends = [0, *(r.offset + r.length for r in members)]
        assert [r.offset for r in members] == ends[:-1]
        assert ends[-1] == 2048 or number == max(of) and ends[-1] < 2048
    assert sorted(of) == list(range(len(of)))
    stream = [(r.doc_id, r.start, r.doc_tokens, np.frombuffer(bytes(r.ids), dtype="<u4").tolist()) for n in sorted(of) for r in of[n]]
    whole, current = Counter(), []
    for doc_id, start, total, part in stream:
        assert start == len(current)
        current += part
        if len(current) == total:
            whole[(doc_id, tuple(current))] += 1
            current = []
    assert not current
    assert whole == Counter((d, tuple(ids[d, t])) for d, t in some)


def test_sequences_hold_the_pieces_in_order(spark):
    found = packing.pack(cases.documents(spark), vocabulary("byte_bpe_50k.json"), window=64)
    rows = packing.sequences(found, 64, pad_id=50256).collect()
    parts = defaultdict(list)
    for r in found.collect():
        parts[r.sequence_id].append((r.offset, bytes(r.ids)))
    for row in rows:
        ids = b"".join(x for _, x in sorted(parts[row.sequence_id]))
        assert bytes(row.ids) == ids + (50256).to_bytes(4, "little") * (64 - row.tokens) and len(row.ids) == 256


def test_encoder_gives_the_tokenizers_ids():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rng, of = random.Random(4), packing.Encoder(vocabulary("byte_bpe_50k.json"))
    assert np.frombuffer(of("a <|endoftext|> b"), dtype="<u4").tolist() == [64, 220, 50256, 275]
    marks = [" ", "  ", "\n", " \n", "\t", " ", " ", "\x1c", "a", "Bc", "é", "12", "'s", "'ll", "!?", "🎉", "<|endoftext|>", "你"]
    texts = ["", " ", "  a", "a  ", *("".join(rng.choice(marks) for _ in range(rng.randint(1, 25))) for _ in range(2000))]
    texts += ["a" * 20_000, "é 12" * 5000, "".join(map(chr, range(0x3000)))]
    escaped = packing.Encoder(vocabulary("byte_bpe_50k.json"), escape=True)
    for of, escape in ((of, False), (escaped, True)):
        plain.encode_special_tokens = escape
        for text in texts:
            assert np.frombuffer(of(text), dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_encoder_of_long_white_space(monkeypatch):
    from tokenizers import Tokenizer

    plain, of = Tokenizer.from_file(vocabulary("byte_bpe_50k.json")), packing.Encoder(vocabulary("byte_bpe_50k.json"))
    same = lambda text: np.array_equal(np.frombuffer(of(text), dtype="<u4"), plain.encode(text, add_special_tokens=False).ids)
    runs = [" " * 2_000_000, "\n" * 2_000_000]
    assert all(same(text) for text in (runs[0], f"a{runs[0]}b", f"{runs[1]}a  b", f"a {runs[1]}!{runs[0]}"))
    monkeypatch.setattr(packing, "LONG_RUN", 2)
    rng, marks = random.Random(5), [*" \t\n\r\v\f\x1c\x1f\x85\xa0\u1680\u180e\u2003\u200b\u2028\u202f\u205f\u3000\ufeff", "a", "12", "!", "'s"]
    assert all(same("".join(rng.choice(marks) for _ in range(rng.randint(1, 12)))) for _ in range(5000))


def test_sharding(given):
    docs, some = given
    found = sharding.sharded(docs).collect()
    data = [(d, (t or "").encode()) for d, t in some]
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == Counter((d, len(t) + 16, zlib.crc32(t)) for d, t in data)
    for shard in range(40):
        places = sorted(r.slot for r in found if r.shard == shard)
        assert places == list(range(len(places)))
    assert all(r.law == "bytes" and 0 <= r.shard < 40 and r.grown_shard is None for r in found)


def test_repeated_rows_spread_over_shards(spark):
    many = spark.range(0, 20_000, 1, 5).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit("x").alias("repeat"), F.lit(1).alias("_key"))
    few = spark.range(3000).select("id", F.concat(F.lit("text "), F.col("id").cast("string")), F.lit("y"), F.lit(2))
    rows = sharding.sharded(many.union(few)).select("doc_id", "size", "shard", "slot", "virtual_slot").collect()
    held = Counter()
    for r in rows:
        held[r.shard] += r["size"]
    assert len(rows) == 23_000 and len(held) == 40
    assert max(held.values()) - min(held.values()) <= 0.02 * sum(held.values()) / 40
    assert max(Counter(r.virtual_slot for r in rows).values()) < 30
    for shard in range(40):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def test_map_is_edited_sparingly():
    rng = random.Random(1)
    first = sharding.first_map(2000, 10)
    sizes = {slot: rng.randint(1, 1000) for slot in range(2000)}
    once = sharding.rebalanced(first, sizes, 10)
    loads = [sum(sizes[s] for s in range(2000) if once[s] == shard) for shard in range(10)]
    assert max(loads) - min(loads) < 1000
    assert sum(a != b for a, b in zip(first, once)) < 200
    more = sharding.rebalanced(once, sizes, 11)
    moved = [s for s in range(2000) if more[s] != once[s]]
    moved_bytes, total = sum(sizes[s] for s in moved), sum(sizes.values())
    assert moved_bytes < 1.2 * total / 11 and sum(sizes[s] for s in moved if more[s] == 10) > 0.9 * moved_bytes
    fewer = sharding.rebalanced(more, sizes, 9)
    assert set(fewer) == set(range(9)) and sharding.rebalanced(first, {}, 10) == first


def test_licenses(given):
    docs, some = given
    found = licenses.license_scan(docs)
    assert counted(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == cases.licenses(some)
    labels = {r.doc_id: (r.labels, r.score) for r in found.collect()}
    if some:
        assert labels[500] == ("mit,mit-notice", 1.0)
        assert "mit-text" in labels[503][0] and labels[503][1] >= 0.8
        assert labels[0] == ("", 0.0) and labels[300] == ("", 0.0) and labels[301] == ("", 0.0)


def test_license_key_phrase_is_mandatory(spark):
    notice = licenses.TEMPLATES["mit-text"].replace("[", "").replace("]", "")
    rows = [(1, notice), (2, notice.replace("without restriction", "with restriction")), (3, "filler " * 50 + notice.replace("person", "body") + " filler" * 50), (4, " ".join(reversed(notice.split())))]
    rows += [(10 + i, cases.prose(random.Random(i), 30)) for i in range(40)]
    found = {r.doc_id: r.labels for r in licenses.license_scan(cases.documents(spark, rows)).collect()}
    assert (found[1], found[2], found[3], found[4]) == ("mit-text", "", "mit-text", "")


def _notices(text: str) -> str:
    """Labels of the templates that hold at any place of a text without base phrases."""
    words, out = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", cases.lowered(text)), []
    for label, template in licenses.template_words().items():
        key = {k + j: w for k, phrase in licenses.key_phrases()[label] for j, w in enumerate(phrase)}
        first, word = min(key.items())
        for start in (i - first for i, w in enumerate(words) if w == word):
            at = [words[start + k] if 0 <= start + k < len(words) else None for k in range(len(template))]
            if all(at[k] == w for k, w in key.items()) and sum(a == w for a, w in zip(at, template)) >= licenses.SHARE * len(template):
                out.append(label)
    return ",".join(sorted({*out}))


def _labels(spark, rows) -> dict[int, str]:
    return {r.doc_id: r.labels for r in licenses.license_scan(cases.documents(spark, rows)).collect()}


def test_license_that_most_documents_hold(spark):
    notice = "All rights reserved."
    rows = [(i, f"{cases.prose(random.Random(i), 20)} {notice if i % 5 else ''}") for i in range(50)]
    assert _labels(spark, rows) == {i: "reserved" if i % 5 else "" for i in range(50)}


def test_licenses_beside_each_other_and_in_long_texts(spark):
    rng = random.Random(8)
    texts = {label: text.replace("[", "").replace("]", "") for label, text in licenses.TEMPLATES.items()}
    plain = [label for label in texts if not _labels_of_phrases(texts[label])]
    rows = [(100 * i + j, f"{texts[a]}. {texts[b]}") for i, a in enumerate(plain) for j, b in enumerate(plain)]
    words = sorted({w for label in plain for w in texts[label].lower().split()})
    chance = " ".join(rng.choice(words) for _ in range(100_000))
    rows += [(5000, chance), (5001, f"{chance}. {texts['bsd-text']}. {texts['isc-text']}"), (5002, f"All rights reserved. {chance}")]
    rows += [(6000 + i, cases.prose(rng, 30)) for i in range(150)]
    found = _labels(spark, rows)
    assert found == {i: _notices(text) for i, text in rows}
    assert found[100 * plain.index("mit-text") + plain.index("reserved")] == "mit-text,reserved"


def _labels_of_phrases(text: str) -> list[str]:
    return [label for phrase, label in licenses.PHRASES.items() if phrase in text.lower()]


def test_quality(given, labels):
    docs, some = given
    found = quality.quality(docs, labels)
    assert counted(found, "doc_id", *quality.RULES, "base_failed") == cases.rules(some)
    assert all(not (r.base_failed and r.kept) for r in found.collect())


def test_quality_without_trusted_rows(spark, labels):
    found = quality.quality(cases.documents(spark), labels.filter("false")).collect()
    assert all(r.kept != r.base_failed for r in found)


def test_quality_prefers_what_is_like_trusted_text(spark):
    rng = random.Random(2)
    good = [(i, cases.prose(rng, 60)) for i in range(200)]
    junk = [(1000 + i, " ".join(rng.choice("@@ qq zz 99 ## xx vv".split()) + str(rng.randint(0, 50)) for _ in range(60))) for i in range(100)]
    labels = spark.createDataFrame([(i, 1) for i in range(100)], "doc_id long, quality int")
    found = {r.doc_id: r for r in quality.quality(cases.documents(spark, good + junk), labels).collect()}
    assert sum(found[i].kept for i, _ in good) >= 195 and not any(found[i].kept for i, _ in junk)


def test_quality_threshold_is_from_all_trusted_rows(spark):
    ids = spark.range(60_000).withColumnRenamed("id", "doc_id")
    low = F.xxhash64("doc_id") > int(0.96 * 2**63)  # one in fifty, all of them late in the order of hashes
    judged = ids.select("doc_id", F.lit(1).alias("grams"), F.when(low, -1.0).otherwise(0.5).alias("score"))
    assert quality.threshold(judged, ids.withColumn("quality", F.lit(1))) == -1.0


def test_quality_counts_all_trusted_rows(spark):
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.when(F.xxhash64("id") > int(0.96 * 2**63), "late").otherwise("early").alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(None, "no id"), (70_000, "no label")], "doc_id long, text string"))
    ratios = quality.log_ratios(docs, docs.filter("doc_id < 60000").withColumn("quality", F.lit(1)))
    assert all(abs(ratios[quality.Words([word]).buckets(0)[0]]) < 0.5 for word in ("late", "early"))


def test_quality_filter_grows_with_the_ids():
    assert quality._filter_bits(0) == quality._filter_bits(256) == 1 << 15
    assert quality._filter_bits(257) == 1 << 16 and quality._filter_bits(10**12) == quality.FILTER_BITS


def test_quality_filter_passes_every_id(spark):
    ids = spark.range(20_000).filter("id % 2 = 0").union(spark.createDataFrame([(-5,), (2**62,)], "id long"))
    passed = lambda some: some.filter(quality._may_be_in(ids)(quality._slot(F.col("id")))).count()
    assert passed(ids) == ids.count() and passed(spark.range(10**6, 10**6 + 10_000)) < 100


def test_repeated_words_against_plain():
    rng = random.Random(6)
    for _ in range(300):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 60))]
        wanted = next(iter(cases.rules([(1, " ".join(words))])))[5]
        assert quality.repeated_words(np.unique(words, return_inverse=True)[1] if words else np.empty(0, dtype=np.int64)) == wanted


def test_pages_to_warc_and_back(spark):
    some = cases.pages()
    pages = spark.createDataFrame(some, "page_id long, url string, html string").withColumn("payload", F.lit("own"))
    pages.createOrReplaceTempView("warc_pages")
    from tidegauge.llm import queries

    found = queries.op1_warc(_Reader(spark, pages), "unused")
    assert counted(found, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == cases.warc(some)
    none = queries.op1_warc(_Reader(spark, pages.limit(0)), "unused")
    assert none.count() == 0


class _Reader:
    """A session whose tables are given."""

    def __init__(self, spark, pages):
        self._spark, self._pages = spark, pages
        self.read = self

    def parquet(self, _path):
        return self._pages

    def format(self, name):
        return self._spark.read.format(name)

    def __getattr__(self, name):
        return getattr(self._spark, name)


@pytest.mark.parametrize("version", ["1", "2"])
def test_arc_by_declared_lengths(spark, version):
    bodies = [b"", b"\n\nhttp://x 0.0.0.0 20240101000000 text/html 3\nabc", b"\xff\xfe\x00binary", b"x" * 2000]
    data = warc.arc_header(version, "a.arc", "20010203040506")
    for i, body in enumerate(bodies):
        data += warc.arc_record(version, f"http://h/{i} q", "200102030405", "text/plain", body, "a.arc", len(data))
    found = list(warc.arc_records(data))
    assert [body for _, body in found] == bodies and [h["url"] for h, _ in found] == [f"http://h/{i} q" for i in range(4)]
    for broken in (data[:-5], data.replace(b"filedesc", b"http"), b"junk"):
        with pytest.raises(ValueError):
            list(warc.arc_records(broken))
    archives = spark.createDataFrame([(bytearray(data),), (None,)], "content binary")
    records = warc.converted(archives).withColumn("key", F.regexp_extract("uri", r"/(\d)", 1).cast("long"))
    back = warc.read_warc(spark, warc.write_warc(warc.with_revisits(records, "key"), "key")).collect()
    assert {r.key: bytes(r.payload) for r in back} == dict(enumerate(bodies))
    assert {r.date for r in back} == {"2001-02-03T04:05:00Z"} and len({r.record_id for r in back}) == 4


def test_warc_files_are_cut_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 100_000)
    rng = random.Random(9)
    bodies = [rng.randbytes(rng.choice([0, 3000, 30_000, 300_000])) for _ in range(80)] + [b"same" * 1000] * 20
    data = [warc.arc_header("1", "a.arc", "20010203040506")] + [warc.arc_record("1", f"http://h/{i}", "20010203040506", "text/plain", body, "a.arc", 0) for i, body in enumerate(bodies)]
    archives = spark.createDataFrame([(bytearray(b"".join(data)),)], "content binary")
    records = warc.converted(archives).withColumn("key", F.regexp_extract("uri", r"h/(\d+)", 1).cast("long"))
    path = warc.write_warc(warc.with_revisits(records, "key"), "key")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()
    assert len(files) > 20 and all(len(gzip.decompress(bytes(f.content))) < 100_000 + 300_000 + 1500 for f in files)
    back = {r.key: (r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in warc.read_warc(spark, path).collect()}
    assert back == {i: ("response", None, b) if i < 80 or i == 99 else ("revisit", 99, None) for i, b in enumerate(bodies)}


def test_warc_times():
    assert warc.iso_time("20240230000000") == "1970-01-01T00:00:00Z" and warc.iso_time("") == "1970-01-01T00:00:00Z"


def test_pieces(given):
    import sentencepiece

    docs, some = given
    model = vocabulary("piece_bpe_32k.model")
    plain = sentencepiece.SentencePieceProcessor(model_file=model)
    found = pieces.decoded(pieces.encoded(docs.select("doc_id", "text"), model), model).collect()
    wanted = Counter((d, t, None if t is None else tuple(plain.encode(t))) for d, t in some)
    assert Counter((r.doc_id, r.text, None if r.ids is None else tuple(r.ids)) for r in found) == wanted
    assert all(r.decoded == r.text for r in found)


def test_pieces_as_merging_gives_them():
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    plain, of, back = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Encoder(path), pieces.Decoder(path)
    rng = random.Random(8)
    names = [x.replace("▁", " ") for x in of.v.ids]
    texts = ["".join(rng.choice(names) for _ in range(25)) for _ in range(800)] + ["".join(rng.choice("abcdeinost  \n\0é你🎉") for _ in range(60)) for _ in range(800)] + ["a" * 3000, " " * 500]
    for text, ids in zip(texts, of(texts)):
        assert ids.tolist() == plain.encode(text) and back(ids.tolist()) == text


def test_suffixes_are_sorted():
    rng = random.Random(9)
    for _ in range(30):
        codes = np.array([rng.randint(1, 4) for _ in range(rng.randint(1, 200))], dtype=np.int32)
        order = pieces.suffix_array(codes, 16).tolist()
        keys = [codes[i : i + 16].tolist() for i in order]
        assert sorted(order) == list(range(len(codes))) and keys == sorted(keys)


VALUES = {
    "card": (r"\d{16}", [f"{n:015d}" for n in range(400_000_000_000_000, 400_000_000_000_300)]),
    "date": (r"\d{4}-\d\d-\d\d", [f"{y}-{m:02d}-{d:02d}" for y in (1700, 1999, 2000, 2099) for m in range(1, 13) for d in range(1, 29, 3)] + ["2000-02-29", "2099-12-31"]),
    "ip": (r"\d+\.\d+\.\d+\.\d+", [f"10.{a}.{b}.7" for a in range(0, 256, 15) for b in range(0, 256, 15)]),
    "ssn": (r"\d{3}-\d\d-\d{4}", [f"{a:03d}-{b:02d}-{c:04d}" for a in (1, 665, 667, 899) for b in (1, 50, 99) for c in (1, 77, 9999)]),
    "phone": (r"\+1 \(\d{3}\) \d{3}-\d{4}", [f"+1 ({a}) 555-{n:04d}" for a in (200, 999) for n in range(0, 9999, 97)]),
    "email": (r"[a-z.]+\d+@ex\.org", [f"ab.cd{n}@ex.org" for n in range(100, 400)]),
}


def _check_digit(front: str) -> str:
    return next(front + d for d in "0123456789" if _luhn(front + d))


def _luhn(digits: str) -> bool:
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


@pytest.mark.parametrize("kind", VALUES)
def test_pseudonyms_are_a_permutation_within_the_format(spark, kind):
    import datetime

    form, values = VALUES[kind]
    values = [_check_digit(x) for x in values] if kind == "card" else values
    table = spark.createDataFrame([(i, f"x {v}, y") for i, v in enumerate(values)], "doc_id long, text string")
    new = {r.doc_id: r.text for r in pii.pseudonymise(table, "key").collect()}
    found = [new[i][2:-3] for i in range(len(values))]
    assert len(set(found)) == len(set(values)) and all(re.fullmatch(form, x) for x in found)
    assert sum(a == b for a, b in zip(found, values)) <= 1
    assert all(_luhn(x) for x in found if kind == "card")
    if kind == "date":
        assert all(datetime.date(1700, 1, 1) <= datetime.date.fromisoformat(x) <= datetime.date(2099, 12, 31) for x in found)
    other = {r.doc_id: r.text for r in pii.pseudonymise(table, "another key").collect()}
    assert other != new


def test_small_permutations_are_whole(spark):
    pairs = spark.range(6 * 35).select(pii.permuted_pair(F.floor(F.col("id") / 35), F.col("id") % 35, 6, 35, "key", "t").alias("p")).select("p.*").collect()
    assert {(r.l, r.r) for r in pairs} == {(a, b) for a in range(6) for b in range(35)}
    texts = spark.range(2600).select(F.concat(F.lpad(F.floor(F.col("id") / 26).cast("string"), 2, "0"), F.substring(F.lit(pii.LOWER), (F.col("id") % 26 + 1).cast("int"), F.lit(1))).alias("s"))
    found = {r.p for r in texts.select(pii.permuted_text(F.col("s"), pii.by_class, "key", "t").alias("p")).collect()}
    assert len(found) == 2600 and all(re.fullmatch(r"\d\d[a-z]", x) for x in found)


def test_pseudonyms_link_and_leave_the_rest(given):
    docs, some = given
    found = pii.pseudonymise(docs, "key")
    assert found.columns == docs.columns
    texts = Counter((r.doc_id, r.text) for r in found.select("doc_id", "text").collect())
    clean = Counter((d, t) for d, t in some if d not in (600, 601))
    assert not clean - texts and sum(texts.values()) == len(some)
    if some:
        changed = {d: t for d, t in texts if d in (600, 601)}
        card = re.search(r"card (\d{16}) ", changed[600])[1]
        assert card != "4041894974608795" and f"{card[:4]}-{card[4:8]}-{card[8:12]}-{card[12:]} and 4041894974608796" in changed[601]
        assert not re.search(r"bo\.42@|555-3296|10\.0\.0\.1|1980-02-29", changed[600])


def test_addresses_end_at_their_last_letter_label(spark):
    given = ["bo.smith@ex.org-thanks", "bo.smith@ex.org- x", "bo.smith@ex.org2", "to bo.smith@ex.org.", "jörg.meier@ex.org, ja", "bo.smith@a-1.b2.ex.co.uk!"]
    table = spark.createDataFrame(list(enumerate(given)), "n long, text string")
    found = {r.n: r.text for r in pii.pseudonymise(table, "key").collect()}
    names = {re.sub(r"^to |@.*", "", found[n]) for n in (0, 1, 2, 3, 5)}
    assert len(names) == 1 and names != {"bo.smith"} and re.fullmatch(r"[a-z]{2}\.[a-z]{5}", *names)
    assert [re.sub(r".*?@", "", found[n]) for n in range(6)] == [re.sub(r".*?@", "", x) for x in given]
    assert re.fullmatch(r"[a-z]ö[a-z]{2}\.[a-z]{5}@ex\.org, ja", found[4]) and not found[4].startswith("jörg.meier")


def test_what_is_not_valid_stays(spark):
    texts = ["4111111111111112", "000-12-3456", "2021-02-29", "2.0.1", "12345", "1.2.3.400", "AB12CD34EF56GH78", "a@b", "x" * 50_000, "@" * 2000, "a." * 5000 + "@", "1-" * 3000]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.pseudonymise(table, "key").collect()} == dict(enumerate(texts))


def test_toxicity_of_odd_rows(given, labels):
    docs, some = given
    found = toxicity.toxicity(docs, labels).collect()
    assert Counter(r.doc_id for r in found) == Counter(d for d, _ in some)
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_toxicity_finds_held_out_texts(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(i, cases.prose(rng, rng.randint(5, 150))) for i in range(500)]
    bad = {i for i, _ in rows if i % 4 == 0}
    slur = lambda: "grumpf" + rng.choice(cases.WORDS)
    rows = [(i, t if i not in bad else " ".join(x for w in t.split() for x in ([w, slur()] if rng.random() < 0.1 else [w])) + " " + slur()) for i, t in rows]
    rows += [(None, None), (1000, "")]
    labels = spark.createDataFrame([(i, int(i in bad)) for i in range(500)], "doc_id long, toxic int")
    docs = cases.with_extra(cases.documents(spark, rows))
    found = [r for r in toxicity.toxicity(docs, labels).collect() if r.held_out and r.doc_id is not None]
    hit = sum(r.predicted for r in found if r.doc_id in bad) / sum(r.doc_id in bad for r in found)
    wrong = sum(r.predicted for r in found if r.doc_id not in bad) / sum(r.doc_id not in bad for r in found)
    assert hit >= 0.9 and wrong <= 0.05
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() < len(rows)


def test_training_sample_counts_rows():
    rows = [(2, 0, ["b", "abcd", "b"]), (1, 1, ["abcd", "c"]), (2, 0, ["abcd"]), (3, 1, ["abcd"])]
    sample = toxicity.Sample.of(iter(rows))
    assert sample.vocabulary == ["abcd", "b", "c"] and sample.owner.tolist() == [1, 2, 2, 3]
    assert sample.windows[:, :3].tolist() == [[0, 2, 3], [0, 3, 3], [1, 0, 1], [0, 3, 3]]
    evidence = toxicity.Evidence.learn(sample)
    seen = (np.log(2.5 / 3) - np.log(1.5 / 2)) * 3 / 11 / 3  # by both toxic rows and the one other row
    assert evidence.words == pytest.approx({"abcd": seen}) and evidence.grams == pytest.approx({g: seen for g in ("^abc", "abcd", "bcd$")})
    assert toxicity.train(iter([])) is None and toxicity.train(iter(rows[:1])) is None


def test_windows_cover_every_word():
    for count in range(0, 200):
        starts = toxicity.starts_of(count)
        covered = {w for s in starts for w in range(s, min(count, s + toxicity.WIDTH))}
        assert covered == set(range(count)) and starts == sorted(set(starts))


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(3)
    network = toxicity.Network(toxicity.Evidence({"a": 1.0, "b": -0.5}, {"^a$": 0.7}))
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    table = network.table(["a", "b", "cde", "abc"])
    windows, labels = rng.integers(0, 5, (6, 7)), np.array([0, 1, 1, 0, 1, 0.0])
    windows[:, 0] = 1

    def loss():
        p = toxicity._sigmoid(network.forward(table, windows))
        return float(-(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean())

    gradient = network.gradient(table, windows, labels)
    for name, value in network.p.items():
        places = np.flatnonzero(np.abs(gradient[name]).ravel() > 1e-4)[:5]
        for place in places:
            old = value.flat[place]
            value.flat[place] = old + 1e-3
            up = loss()
            value.flat[place] = old - 1e-3
            down = loss()
            value.flat[place] = old
            assert abs((up - down) / 2e-3 - gradient[name].flat[place]) < 2e-3 * max(1, abs(gradient[name].flat[place])), name
