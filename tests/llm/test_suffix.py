"""Suffix sorting and the removal of repeated passages against plain versions."""

import hashlib
import random

import numpy as np
import pytest

from sedimenta.llm import induced, suffix_dedup
from sedimenta.llm.anchors import anchors, segment_digests


def plain_order(text):
    text = list(map(int, text))
    return sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("memory", [4, 1 << 20])
def test_suffix_array_equals_sorting(memory):
    rng = np.random.default_rng(memory)
    cases = [np.zeros(0, int), np.array([3]), np.zeros(40, int), np.tile([5, 1, 700], 30), np.arange(50)[::-1]]
    cases += [rng.integers(0, k, n) * scale for k in (2, 3, 7) for n in (5, 40, 200) for scale in (1, 997)]
    cases += [rng.integers(0, 400, 900)]
    for text in cases:
        assert induced.suffix_array(text, memory).tolist() == plain_order(text)
        assert induced.suffix_array(text, memory, short=12).tolist() == plain_order(text)
        assert len(text) == 0 or induced.doubled(text).tolist() == plain_order(text)


def test_common_prefixes_stop_at_the_row_and_the_limit():
    data = np.frombuffer(b"abcabcabcdabcabcabcd" * 3, np.uint8)
    order = np.array(plain_order(data))
    room = np.repeat([30, 60], 30) - np.arange(60)
    got = induced.common_prefixes(data, order, room, 17)
    for k in range(1, 60):
        a, b = order[k - 1], order[k]
        limit = min(17, room[a], room[b])
        n = next((j for j in range(limit) if data[a + j] != data[b + j]), limit)
        assert got[k] == n


def test_equal_windows_share_an_anchor(monkeypatch):
    from sedimenta.llm import anchors as module
    rng = random.Random(2)
    passage = bytes(rng.randrange(97, 123) for _ in range(230))
    texts = [bytes(rng.randrange(97, 123) for _ in range(rng.randrange(0, 500))) + passage
             + bytes(rng.randrange(97, 123) for _ in range(300)) for _ in range(4)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    whole = anchors(data, offsets, 200)
    monkeypatch.setattr(module, "CHUNK", 64)
    for a, b in zip(whole, anchors(data, offsets, 200)):
        assert a.tolist() == b.tolist()
    place, gram, _ = whole
    for s in range(31):
        held = []
        for text, start in zip(texts, offsets):
            begin = start + text.index(passage) + s
            held.append({(int(p - begin), int(g)) for p, g in zip(place, gram) if begin <= p <= begin + 136})
        assert set.intersection(*held)


def test_digests_tell_bytes_places_and_keys_apart():
    rng = random.Random(9)
    data = np.frombuffer(bytes(rng.randrange(97, 123) for _ in range(336)) * 2 + b"!" * 336, np.uint8)
    around = np.array([[0, 336], [336, 672], [0, 336], [0, 335], [672, 1008]])
    place = np.array([136, 472, 135, 136, 808])
    held = segment_digests(data, place, around, b"one")
    assert held[0] == held[1] and len(set(held.tolist())) == 4
    other = data.copy()
    other[200] ^= 1
    assert segment_digests(other, place, around, b"one")[0] != held[0]
    assert not set(segment_digests(data, place, around, b"two").tolist()) & set(held.tolist())
    assert len(segment_digests(data, place[:0], around[:0], b"one")) == 0


def plain(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for p in range(len(d) - length + 1):
            seen[d[p:p + length]] = seen.get(d[p:p + length], 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            if seen[d[p:p + length]] > 1:
                gone[p:p + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(rng):
    def words(n):
        return " ".join("".join(rng.choices("abcdé", k=rng.randrange(2, 8))) for _ in range(n))

    passage, other = words(60), words(35)
    texts = [words(rng.randrange(0, 120)) for _ in range(25)]
    texts += [words(20) + " " + passage + " " + words(rng.randrange(40)) for _ in range(12)]
    texts += [passage[:250] + words(30), words(10) + passage[100:], other + words(9) + other, "ab " * 200, "x" * 900,
              "x" * 700 + "y", None, "", "short", texts[0], texts[3], texts[3], words(4000)]
    near = texts[30].split()
    near[len(near) // 2] = "changed"
    return [*texts, " ".join(near)]


@pytest.mark.parametrize("block, shard", [(4, 100), (1024, 6000)])
def test_removed_bytes_equal_brute_force(documents, block, shard):
    texts = corpus(random.Random(block))
    docs = documents(list(enumerate(texts)), True)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup.digest(docs, block=block, shard_segments=shard).collect()}
    assert got == dict(enumerate(plain(texts, 200)))


def test_segments_of_a_common_passage_are_not_dealt_in_pairs(documents, monkeypatch):
    """A passage that many texts hold between words of their own: what is sorted grows with the texts, not with their square."""
    rng, dealt = random.Random(8), []

    def words(n):
        return " ".join("".join(rng.choices("abcde", k=rng.randrange(2, 8))) for _ in range(n))

    passage, cut = words(70), words(45)
    for texts in (40, 160):
        held = [words(30) + passage + words(30) for _ in range(texts)] + [words(20) + cut[n % 9:200 + n % 30] + words(9) for n in range(texts)]
        held += [passage, passage[7:], words(3) + passage[:201]]
        docs, counts = documents(list(enumerate(held))), []
        frame, count = type(docs), type(docs).count
        with monkeypatch.context() as patch:
            patch.setattr(frame, "count", lambda self: counts.append(count(self)) or counts[-1])
            got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                   for r in suffix_dedup.digest(docs, block=8, shard_segments=200).collect()}
        assert got == dict(enumerate(plain(held, 200)))
        dealt.append(max(counts))
    assert dealt[1] < 6 * dealt[0]


def test_documents_are_rewritten_in_place(documents):
    passage = "".join(random.Random(1).choices("abcdefgh ", k=300))
    docs = documents([(1, "first " + passage), (2, passage + " second"), (3, None), (None, "alone"), (4, "é" * 150), (5, "é" * 150)], True)
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert (rows[1].text, rows[2].text, rows[3].text, rows[None].text, rows[4].text) == ("first ", " second", None, "alone", "")
    assert (rows[1].n_chars, rows[4].n_chars) == (6, 0)
    assert suffix_dedup.without_repeats(documents([])).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.digest(docs, length=10)


def test_runs_with_a_short_period_equal_brute_force(documents):
    """Runs of one byte and of a few, of every length near the limit, alone, inside texts, and in several texts."""
    rng = random.Random(4)

    def words(n):
        return " ".join("".join(rng.choices("abcdef", k=5)) for _ in range(n))

    texts = [words(30) + "=" * n + words(30) for n in (199, 200, 201, 202, 263, 264, 400, 1000, 5000)]
    texts += [words(9) + ("xyz" * 400)[:n] + words(9) for n in (150, 200, 202, 203, 300, 900)]
    texts += ["-" * 200, "-" * 201, "~" * 200, "~" * 200 + "q", " " * 3000, "ab\n" * 900, ("abc" * 21 + "d") * 40, "é" * 700,
              "x" * 600 + "y" * 600 + "x" * 600, words(3) + "=" * 210 + "." + "=" * 230, ("0123456789" * 7)[:65] * 20, ("0123456789" * 7)[:64] * 20]
    docs = documents(list(enumerate(texts)), False, 1)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digest(docs).collect()}
    assert got == dict(enumerate(plain(texts, 200)))


def test_a_long_run_leaves_few_anchors_and_spans(spark, documents):
    data = np.frombuffer(b"start" * 3 + b"=" * 3_000_000 + b"abc" * 500_000, np.uint8)
    place, gram, _ = anchors(data, np.array([0, len(data)]), 200)
    low, high, inner = suffix_dedup.periodic_runs(data, place, gram, np.zeros(len(place), int), 200)
    assert len(place) > 3_000_000 and (~inner).sum() < 2000
    assert high[0] - low[0] > 2_999_000 and len(low) <= 3
    spans = spark.range(0, 400_000).selectExpr("0L row", "id as low", "id + 200 as high")
    merged = suffix_dedup.merged_spans(spans, 16)
    assert sorted((r.low, r.high) for r in merged.collect()) == [
        (n << 16, min((n + 1) << 16, 400_000) + 199) for n in range(7)]
    text = "=" * 8_000_000
    row = suffix_dedup.digest(documents([(1, text)])).first()
    assert (row.n_bytes, row.n_removed, row.n_spans) == (8_000_000, 8_000_000, 1)
