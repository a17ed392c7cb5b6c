"""The toxicity network against plain loops, what it is trained on, and encoding in one task."""

import os
import random
import subprocess
import sys

import numpy as np
import pytest

import cases
from tidegauge.llm import pieces, toxicity
from tidegauge.llm.queries import vocabulary


def training_rows():
    rng = random.Random(8)
    for i in range(80):
        words = cases.prose(rng, rng.randint(3, 32)).split(" ")
        yield i, i % 2, words + (["grumpf" + rng.choice(cases.WORDS)] if i % 2 else [])[: max(0, 32 - len(words))]


@pytest.fixture(scope="module")
def network():
    return toxicity.train(training_rows())


def plain_score(network, text: str) -> float:
    """Each window by itself, each step by its formula."""
    p, size, words = network.p, toxicity.HIDDEN, toxicity.words_of(text)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    best = toxicity.EMPTY_SCORE
    for start in toxicity.starts_of(len(words)):
        inputs = network.vectors(network.table(words[start : start + toxicity.WIDTH]))[:-1].astype(np.float64)
        sides = []
        for side, some in (("f", inputs), ("b", inputs[::-1])):
            h, states = np.zeros(size), []
            for x in some:
                a, r = x @ p[f"w{side}"] + p[f"c{side}"], h @ p[f"u{side}"]
                z, reset = sigmoid(a[:size] + r[:size]), sigmoid(a[size : 2 * size] + r[size : 2 * size])
                h = z * h + (1 - z) * np.tanh(a[2 * size :] + reset * r[2 * size :])
                states.append(h)
            sides.append(states if side == "f" else states[::-1])
        both = np.concatenate(sides, axis=1)
        weights = np.exp(np.tanh(both @ p["a"] + p["d"]) @ p["v"])
        best = max(best, float(sigmoid((weights / weights.sum()) @ both @ p["o"] + p["e"][0])))
    return best


@pytest.mark.parametrize("remembered", [40, 200_000])
def test_scores_by_a_plain_loop(network, monkeypatch, remembered):
    """Also when the words of a text do not fit into what is remembered."""
    monkeypatch.setattr(toxicity, "REMEMBERED", remembered)
    monkeypatch.setattr(toxicity, "AT_ONCE", 7)
    rng = random.Random(9)
    texts = [cases.prose(rng, n) for n in (1, 5, 31, 32, 33, 57, 80, 400)] + [None, "", " \n", "grumpfing of the", cases.prose(rng, 90) + " grumpfand"]
    scorer = toxicity.Scorer(network)
    for _ in range(2):
        assert scorer(texts) == pytest.approx([plain_score(network, text) for text in texts], abs=1e-4)


def test_labels_without_documents_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 60)
    rng = random.Random(11)
    rows = [(i, cases.prose(rng, 40) + (" grumpf" + rng.choice(cases.WORDS) if i % 3 == 0 else "")) for i in range(200)]
    docs, known = cases.documents(spark, rows), [(i, int(i % 3 == 0)) for i in range(200)]
    kind = "doc_id long, toxic int"
    first = {(r.doc_id, r.score) for r in toxicity.toxicity(docs, spark.createDataFrame(known, kind)).collect()}
    foreign = known + [(10_000 + i, i % 2) for i in range(3000)]
    assert {(r.doc_id, r.score) for r in toxicity.toxicity(docs, spark.createDataFrame(foreign, kind)).collect()} == first
    assert len({score for _, score in first}) > 1


def test_training_takes_all_windows():
    import pyarrow as pa

    text = " ".join(f"w{i}" for i in range(5000))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1], pa.int32()), pa.array([text])], names=["id", "label", "text"])
    cut = pa.Table.from_batches(list(toxicity._windows()(iter([batch]))))
    assert cut.num_rows == len(toxicity.starts_of(5000)) and {w for x in cut.column(2).to_pylist() for w in x.split()} == set(text.split())


def test_workers_need_no_package(tmp_path):
    """Toxicity and language run where workers cannot import this package."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from tidegauge.session import local_session
from tidegauge.llm import language, toxicity
spark = local_session("far", 2, 2)
docs = spark.createDataFrame([(i, "some words " * (i % 4) + ("grumpf" if i % 2 else "plain"), "en", "s", 1) for i in range(40)], "doc_id long, text string, lang string, source string, n_chars long")
labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
print("rows", len(toxicity.toxicity(docs, labels).collect()), toxicity.without_toxic(docs, labels).count() > 0, len(language.languages(docs).collect()))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 40 True 40" in out.stdout, out.stderr[-2000:]


@pytest.mark.parametrize("rows", [[], [(1, "a b"), (2, None), (3, ""), (1, "a b"), (4, "你好" * 400 + " é x" * 50)]])
def test_round_trips(spark, rows):
    model = vocabulary("piece_bpe_32k.model")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = sorted(map(tuple, pieces.round_trips(docs, model).collect()), key=str)
    assert found == sorted(map(tuple, pieces.decoded(pieces.encoded(docs, model), model).collect()), key=str)
    assert all(text == back for _, text, _, back in found)
    for build in (lambda: pieces.round_trips(docs, model, names=("text", "x")), lambda: pieces.encoded(docs, model, name="doc_id")):
        with pytest.raises(ValueError):
            build()


def test_long_units_are_cut_where_no_piece_crosses():
    import sentencepiece

    path, rng = vocabulary("piece_bpe_32k.model"), random.Random(6)
    plain, of = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Encoder(path)
    texts = ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(2000)), "a" * 300 + "bcd" * 100, "http://" + "x/y?z=1&" * 60, "".join(rng.choice("aeiou你好é.,") for _ in range(3000))]
    assert [ids.tolist() for ids in of(texts)] == [plain.encode(text) for text in texts]
    assert max(map(len, of.units(texts[0]))) < 50
