"""The byte network: gradients, held-out accuracy, whole documents."""

import random
import zlib

import numpy as np
import pytest

from khodat.llm.quality import HALF, THRESHOLD, WIDTH, ByteNetwork, keep_quality, learn, quality_digest, score_documents


def clean(rng):
    return " ".join(rng.choice(["the", "of", "and", "reader", "page", "tree", "house", "it"]) for _ in range(rng.randrange(3, 120))) + "."


def junk(rng):
    return " ".join(rng.choice(["BUY", "NOW", "WIN"]) + rng.choice(["!!!", "$$$", "%%"]) for _ in range(rng.randrange(3, 120)))


def test_gradients_are_those_of_the_loss():
    network, text = ByteNetwork(), b"some text, and some more of it" * 20
    tables, bias, weights, offset = network.gradients(text, 1.0)
    loss = lambda: -np.log(network.score(text))
    for values, gradient in ((network.weights, weights), (network.offset, offset), (network.bias, bias)):
        for i in range(0, len(values), 5):
            before, step = values[i], 1e-2
            values[i] = before + step
            above = loss()
            values[i] = before - step
            below = loss()
            values[i] = before
            assert (above - below) / (2 * step) == pytest.approx(float(gradient[i]), abs=2e-3)
    assert tables.shape == network.tables.shape and np.abs(tables).sum() > 0


def test_responses_are_those_of_the_filters():
    network, text = ByteNetwork(), bytes(range(256)) * 2
    data = network.padded(text)
    plain = sum(network.tables[j][data[j : len(data) - WIDTH + j]] for j in range(WIDTH))
    assert np.allclose(network.responses(text), plain, atol=1e-5)
    tops = np.maximum(plain.reshape(-1, HALF, plain.shape[1]).max(1) + network.bias, 0)
    assert np.allclose(network.chunks(text), np.maximum(tops[:-1], tops[1:]), atol=1e-5)


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 65535, 65536, 65537, 65663, 65664, 65665, 200_000])
def test_long_texts_are_covered_whole(n):
    network, text = ByteNetwork(), np.random.default_rng(n).integers(32, 126, n, np.uint8).tobytes()
    tops = network.responses(text).reshape(-1, HALF, 16).max(1)
    assert np.allclose(network.chunks(text), np.maximum(np.maximum(tops[:-1], tops[1:]) + network.bias, 0), atol=1e-5)


def test_held_out_documents_are_told_apart(spark, documents):
    rng = random.Random(3)
    quality = [int(rng.random() < 0.8) for _ in range(500)]
    docs = documents([clean(rng) if q else junk(rng) for q in quality])
    labels = spark.createDataFrame([(i, q, None, "text") for i, q in enumerate(quality)] + [(None, 1, 1, ""), (3, None, 0, ""), (4, 0, 0, ""), (4, 1, 0, "")], "doc_id long, quality int, toxic int, text string")
    rows = quality_digest(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= THRESHOLD) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(rows) == 500 and sum(r.predicted == quality[r.doc_id] for r in held) >= 0.97 * len(held)
    assert rows == quality_digest(docs, labels).collect()
    kept = keep_quality(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)


def test_odd_texts_and_nothing_to_learn_from(spark, odd, documents):
    none = spark.createDataFrame([], "doc_id long, quality int")
    network = learn(odd, none)
    assert np.array_equal(network.tables, ByteNetwork().tables)
    rows = score_documents(odd, network, "probability").collect()
    assert len(rows) == odd.count() and all(0 <= r.probability <= 1 for r in rows)
    empty = {r.probability for r in rows if not r.text}
    assert len(empty) == 1
    assert quality_digest(documents([]), none).collect() == []
