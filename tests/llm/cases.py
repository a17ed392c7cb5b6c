"""A small table with every odd case, and plain versions of what the operators return."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import xxhash

WORDS = "anble thion erst onha ing the of and ouat leen reau chung keit ment".split()
LICENSE = "Released under the MIT License."


def lowered(text: str | None) -> str:
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def prose(rng: random.Random, count: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(count))


def rows() -> list[tuple[int | None, str | None]]:
    rng = random.Random(3)
    base = [prose(rng, rng.randint(5, 120)) for _ in range(60)]
    out: list[tuple[int | None, str | None]] = list(enumerate(base))
    near = base[7].split(" ")
    out += [(100 + i, " ".join([*near[:i], "x", *near[i + 1 :]])) for i in range(0, 30, 3)]
    out += [(200 + i, base[3].upper() if i % 2 else base[3]) for i in range(12)]
    out += [(300, ""), (301, None), (302, " \t\n"), (303, "a"), (304, "  x\x1cy"), (None, None), (None, "no id"), (None, "no id"), (305, "É Å ﬁ 你好 🎉"), (306, "É å ﬁ 你好 🎉"), (307, "é Å ﬁ 你好 🎉")]
    out += [(310, base[5]), (310, base[5]), (310, base[6]), (5, base[5])]
    out += [(400, prose(rng, 20_000)), (401, "word " * 5000), (402, "line one\nline one\n\n\nline one\r\nx"), (403, "a b c d e a b c d e f a b c d e"), (404, "#*$%&|<> " * 9)]
    out += [(500, f"Text. {LICENSE}"), (501, "cc by cc by-nc 4.0 CC\nBY"), (502, "the GNU general  PUBLIC license; apache license mit license"), (503, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction")]
    out += [(600, "call +1 (269) 555-3296 or mail bo.42@mail8.example.com at 10.0.0.1, card 4041894974608795 born 1980-02-29"), (601, "same card 4041-8949-7460-8795 and 4041894974608796")]
    return out


#: Names that operators use inside, and some of their results.
EXTRA = ("id", "print", "bytes", "words", "number", "ids", "part", "n", "slot", "score", "f", "label", "text_crc32", "keep_id", "found", "trusted", "rare", "_row", "root", "size")


def documents(spark, some=None):
    from pyspark.sql import functions as F

    table = spark.createDataFrame(rows() if some is None else some, "doc_id long, text string").repartition(4)
    return table.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})


def with_extra(docs):
    from pyspark.sql import functions as F

    return docs.withColumns({name: F.lit(f"own {name}") for name in EXTRA})


def exact(some) -> Counter:
    groups: dict[str, list[int | None]] = {}
    for doc_id, text in some:
        groups.setdefault(lowered(text), []).append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        known = [x for x in ids if x is not None]
        top = max(known) if known else None
        left = True
        for doc_id in sorted(ids, key=lambda x: (x is not None, x or 0), reverse=True):
            out[(doc_id, top, len(ids), left, hashlib.sha256(text.encode()).hexdigest())] += 1
            left = False
    return out


def print_of(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def simhash(some, radius: int = 3, least: float | None = None) -> Counter:
    """With ``least``, sets of five-word shingles of that similarity link as well."""
    prints = [print_of(text) for _, text in some]
    sets = [shingles_of(text) for _, text in some]
    label = list(range(len(some)))

    def root(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(some)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius or least and alike(sets[i], sets[j], least):
                label[root(i)] = root(j)
    first: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(some):
        if doc_id is not None:
            first[root(i)] = min(doc_id, first.get(root(i), doc_id))
    return Counter((doc_id, f"{prints[i]:016x}", first.get(root(i))) for i, (doc_id, _) in enumerate(some))


def shingles_of(text: str | None, size: int = 5) -> set[str]:
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    return {" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def alike(a: set[str], b: set[str], least: float) -> bool:
    return bool(a) and len(a & b) >= least * len(a | b)


def rules(some) -> Counter:
    out = Counter()
    for doc_id, text in some:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        often, covered = Counter(windows), set()
        for i, window in enumerate(windows):
            if often[window] > 1:
                covered.update(range(i, i + 5))
        lines, seen, again = (text or "").split("\n"), set(), 0
        for line in lines:
            again += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
            seen.add(line)
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        out[(doc_id, len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), again, len(covered), failed)] += 1
    return out


def licenses(some) -> Counter:
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    out = Counter()
    for doc_id, text in some:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
        places, labels = [], set()
        for phrase, label in phrases.items():
            parts = phrase.split()
            here = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
            places += here
            labels |= {label} if here else set()
        out[(doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))] += 1
    return out


def pages() -> list[tuple[int | None, str | None, str | None]]:
    big, other = "<p>é</p>" * 200, "x" * 999
    return [(1, "http://a/", big), (2, "http://a b/\t", big), (9, None, big), (3, "u", other), (4, "u", other), (5, "u", None), (6, "u", ""), (7, "u#page=77", "y" * 1000), (8, "u", "y" * 1000), (None, "u", "y" * 1000), (10, "u", "a\r\n\r\nWARC/1.0\r\nb\n\nhttp://x 0.0.0.0 2024 text/html 5\nhello"), (11, "u", "z" * 9_000_000), (12, "u", "dup" * 400), (12, "u", "dup" * 400)]


def warc(some) -> Counter:
    bodies = [(page, (html or "").encode()) for page, _, html in some]
    top: dict[bytes, int] = {}
    for page, body in bodies:
        if page is not None:
            top[body] = max(page, top.get(body, page))
    out = Counter()
    for page, body in bodies:
        again = len(body) >= 1000 and page != top.get(body)
        out[(page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", top[body] if again else None)] += 1
    return out


def crc(data: bytes) -> int:
    return zlib.crc32(data)
