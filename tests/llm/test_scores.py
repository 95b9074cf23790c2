import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tripmill.llm import corpus_score, mixing
from tripmill.llm.corpus_score import scores
from tripmill.llm.mixing import Coder, Model, Trainer, groups, packed_logits, pair_counts, paths

from .conftest import clashing, prose


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


def tokens(text):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    return [*(text or "").encode().translate(low).split(), None]


def brute(docs):
    counts = Counter(t for i, x in docs if not held(i) for t in tokens(x))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, x in docs:
        own = tokens(x)
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        out.append((repr(i), held(i), len(own), sum(counts[t] > 0 for t in own), total, base))
    return sorted(out)


def check(df, docs):
    found = scores(df).collect()
    got = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found)
    want = brute(docs)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(math.isclose(g[5], w[5], rel_tol=1e-9) for g, w in zip(got, want))
    return found


def test_edge_documents(documents, no_documents):
    found = check(clashing(documents), [(r.doc_id, r.text) for r in documents.collect()])
    assert all(r.score < 0 for r in found)
    by_text = {}
    for r in found:
        by_text.setdefault(r.doc_id, set()).add(round(r.score, 6))
    assert len(by_text[7] | by_text[8]) == 1  # equal texts have equal scores
    assert scores(no_documents).collect() == []


def test_rare_words_are_joined(spark, monkeypatch):
    monkeypatch.setattr(corpus_score, "TOP", 16)
    monkeypatch.setattr(corpus_score, "SLOTS", 32)
    docs = [(i, prose(i, 60, 300)) for i in range(120)] + [(None, "w1 W1 unknown")]
    check(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5), docs)


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(60) if held(i)]
    docs = [(i, prose(i, 5)) for i in ids]
    check(spark.createDataFrame(docs, "doc_id bigint, text string"), docs)


def train(texts):
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    coder = Coder(pair_counts(data, offsets))
    trainer = Trainer(coder)
    trainer.learn(texts)
    logits = [packed_logits(c.reshape(-1, 2).astype(float)) for c in trainer.counts]
    return Model(coder, logits, trainer.weights, trainer.cells)


@pytest.fixture(scope="module")
def model():
    return train([prose(i, 200, 500).encode() for i in range(300)])


def test_scores_of_all_short_texts_add_up_to_at_most_one():
    model = train([b"ab", b"ba", b"a", b""] * 50)
    texts = [b""] + [bytes([a]) for a in range(255)] + [bytes([a, b]) for a in range(255) for b in range(255)]
    total = float((10.0 ** model.log10_probabilities(texts)).sum())
    assert 0.6 < total <= 1.0001


def test_the_model_learns(model):
    fresh = [prose(1000 + i, 200, 500).encode() for i in range(20)]
    bits = -model.log10_probabilities(fresh).sum() * math.log2(10) / sum(map(len, fresh))
    noise = [bytes(np.random.default_rng(i).integers(0, 127, 1000).astype(np.uint8)) for i in range(5)]
    worse = -model.log10_probabilities(noise).sum() * math.log2(10) / 5000
    packed = 8 * len(zlib.compress(b"".join(fresh), 9)) / sum(map(len, fresh))
    assert bits < packed and worse > 7


def test_scores_do_not_depend_on_neighbours(model):
    texts = [prose(i, n).encode() for i, n in ((1, 3), (2, 40_000), (3, 0), (4, 700))]
    together = model.log10_probabilities(texts)
    alone = [model.log10_probabilities([t])[0] for t in texts]
    assert np.allclose(together, alone, rtol=1e-5)


def by_hand(model, text):
    """The score of a text, decision by decision, in plain Python."""
    hashes, mask = mixing._HASH, 2**32 - 1
    whole = [mixing.END] * 5 + [*text, mixing.END]
    coder, total = model.coder, 0.0
    for i in range(5, len(whole)):
        b = whole[i - 5 : i][::-1]
        two, three = b[0] | b[1] << 8, b[0] | b[1] << 8 | b[2] << 16
        five = ((three | b[3] << 24) * hashes[0] & mask) ^ (b[4] * hashes[1] & mask)
        pair = b[0] * 256 + whole[i]
        first = int(coder.starts[pair])
        for at in range(first, first + int(coder.lengths[pair])):
            logits, seen = [], []
            for k, context in enumerate((two, three, five)):
                x = ((context * hashes[k] & mask) + k + int(coder.spread[at])) & mask
                x = (x ^ x >> 15) * hashes[3] & mask
                value = model.logits[k][x >> 32 - coder.table_bits[k]]
                logits.append(float(value))
                seen.append(int(value.view(np.uint32)) & 3)
            gate = seen[1] * 4 + seen[2]
            mix = sum(w * x for w, x in zip(model.weights[gate], logits))
            cell = model.cells[gate * mixing.CELLS + int(min(max(mix * 4 + mixing.CELLS // 2 + 0.5, 0), mixing.CELLS - 1))]
            n = cell.sum() + 8
            p = (1 / (1 + math.exp(-mix)) * (1 + 8 / n) + cell[1] / n) / 2
            p = p * (1 - 2 * mixing.SURE) + mixing.SURE
            total += math.log10(p if coder.bits[at] else 1 - p)
    return total


def test_scores_by_hand(model):
    texts = [b"", b"a", prose(3, 40, 500).encode(), "w1 漢 W2".encode(), b"w10 w11. w12"]
    got = model.log10_probabilities(texts)
    assert np.allclose(got, [by_hand(model, t) for t in texts], rtol=1e-3)


def test_a_byte_in_a_known_context_is_worked_out_once(model, monkeypatch):
    worked_out = []
    byte_logs = Model.byte_logs

    def counted(self, byte, back):
        worked_out.append(len(byte))
        return byte_logs(self, byte, back)

    monkeypatch.setattr(Model, "byte_logs", counted)
    fresh = Model(model.coder, model.logits, model.weights, model.cells)
    texts = [prose(i, 300, 500).encode() for i in range(40)] + [b"", "漢字 漢字".encode(), bytes(9)]
    first = fresh.log10_probabilities(texts)
    once = sum(worked_out)
    assert 0 < once < sum(len(t) + 1 for t in texts)
    worked_out.clear()
    assert np.allclose(fresh.log10_probabilities(texts), first, rtol=1e-12)
    assert sum(worked_out) < once / 10  # those that lost their slot to another


def test_bytes_that_share_a_slot_keep_their_own_scores(model, monkeypatch):
    texts = [prose(i, 200, 500).encode() for i in range(20)] + [b"", bytes(9)]
    want = Model(model.coder, model.logits, model.weights, model.cells).log10_probabilities(texts)
    monkeypatch.setattr(mixing, "REMEMBERED", 2)
    small = Model(model.coder, model.logits, model.weights, model.cells)
    for _ in range(2):
        assert np.allclose(small.log10_probabilities(texts), want, rtol=1e-12)


def test_tables_grow_with_the_corpus(spark, monkeypatch):
    sizes = [mixing.table_bits(1 << k) for k in (0, 25, 26, 30, 46)]
    assert sizes[:2] == [mixing.BITS] * 2 and [s[0] - mixing.BITS[0] for s in sizes] == [0, 0, 1, 2, 6]
    monkeypatch.setattr(mixing, "LEARNT", 4)
    docs = [(i, prose(i, 60, 300)) for i in range(80)]
    check(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), docs)


def test_counts_travel_without_zeros():
    numbers = np.random.default_rng(1).integers(0, 3, 2 * corpus_score.SEGMENT).astype(np.int32)
    total = np.zeros(len(numbers), np.int64)
    for _ in range(2):
        corpus_score.add_sparse(total, pa.py_buffer(corpus_score.sparse(numbers)))
    assert (total == 2 * numbers).all()


def test_paths_are_a_prefix_code():
    found = paths(np.arange(256) ** 2)
    codes = {"".join(str(b) for _, b in path) for path in found}
    assert len(codes) == 256
    assert math.isclose(sum(2.0 ** -len(c) for c in codes), 1)


def test_pieces_cover_all_bytes():
    texts = [b"", b"x" * 100_000, b"abc"]
    total = sum(int((lengths - mixing.BACK).sum()) for _, _, lengths in groups(texts))
    assert total == sum(len(t) + 1 for t in texts)


def test_pair_counts():
    texts = [b"ab", b"", b"b"]
    got = pair_counts(np.frombuffer(b"abb", np.uint8), np.array([0, 2, 2, 3]))
    want = np.zeros((256, 256), int)
    for t in texts:
        for x, y in zip(bytes([255]) + t, t + bytes([255])):
            want[x, y] += 1
    assert (got == want).all()
