"""Line dedup, resampling and collocations against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import SMALL, assert_same
from hypothesis import given, settings
from hypothesis import strategies as st

from sedimenta.llm import collocations, line_dedup, queries, quotient_filter, resampling

UPPER = {c: c + 32 for c in range(65, 91)}


@pytest.mark.parametrize("name", ["op11_line_dedup", "op12_resampling", "op13_collocations"])
def test_queries_match_sql(spark, name):
    assert assert_same(queries.QUERIES[name](spark, SMALL), queries.ORACLE[name], SMALL) > 0


# --- line dedup -----------------------------------------------------------------------------

LINES = [
    (5, "a common line here\nunique to five 5\n  A Common LINE here\t\nshort"), (2, "\vA COMMON line HERE \r\nshort\n\nÀ common lin"),
    (9, "a common line here"), (7, None), (8, ""), (1, "short\nshort\n"), (4, "é common líne here\nÉ common líne here"),
    (6, "é common líne here\nonly in six and null"), (None, "only in six and null\nnull twice here\nnull twice here"),
    (3, "same rows hold this"), (3, "same rows hold this\nand that, in one"), (11, "ninechars\nten chars!"), (12, "ninechars\nten chars!"),
    (13, "x" * 200_000 + "\n" + "tail line of a long one"), (14, "tail line of a long one\n" * 5000)]


def plain_lines(rows):
    keyed = [(i, [(line, line.strip(" \t\n\v\f\r").translate(UPPER)) for line in (t or "").split("\n")]) for i, t in rows]
    holders = defaultdict(set)
    for i, lines in keyed:
        for _, key in lines:
            if len(key) >= 10:
                holders[key].add(math.inf if i is None else i)
    out = []
    for i, lines in keyed:
        own = math.inf if i is None else i
        kept = [line for line, key in lines if len(holders.get(key, ())) < 2 or min(holders[key]) == own]
        out.append((str(i), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("clashing", [False, True])
def test_lines_of_others_go(documents, clashing):
    docs = documents(LINES, clashing)
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.digest(docs).collect())
    assert got == plain_lines(LINES)
    kept = line_dedup.without_repeated_lines(docs)
    assert kept.columns == docs.columns
    texts = {r.doc_id: r for r in kept.where("doc_id not in (3)").collect()}
    assert texts[9].text == "" and texts[9].n_chars == 0 and texts[7].text is None
    assert texts[2].text == LINES[1][1] and texts[5].text == "unique to five 5\nshort"
    assert kept.count() == len(LINES)


def test_a_higher_threshold_counts_documents(documents):
    docs = documents([(n, "held by three docs\nheld by only two" if n < 2 else "held by three docs") for n in range(3)])
    texts = {r.doc_id: r.text for r in line_dedup.without_repeated_lines(docs, min_documents=3).collect()}
    assert texts == {0: "held by three docs\nheld by only two", 1: "held by only two", 2: ""}


# --- resampling -----------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    words = WORD.findall((text or "").translate(UPPER))
    return len(words), [zlib.crc32(f.encode()) % 10000 for f in [*words, *(" ".join(p) for p in zip(words, words[1:]))]]


def plain_resample(rows, target):
    made = [(i, *plain_features(t)) for i, t in rows]
    s, t = (Counter(b for f in lists for b in f) for lists in ([f for _, _, f in made], [plain_features(x)[1] for x in target]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in s}
    out = []
    for i, words, features in made:
        weight = sum(gain[b] for b in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = Counter()
    drawn = [(str(r[0]), *r[1:4], n + 1) for n, r in enumerate(able[:25 * len(able) // 100])]
    ranks.update((d[0], d[3]) for d in drawn)
    rest = []
    for r in out:
        if ranks[(str(r[0]), r[3])] > 0 and r[4] >= 20:
            ranks[(str(r[0]), r[3])] -= 1
        else:
            rest.append((str(r[0]), *r[1:4], None))
    return sorted(map(str, drawn + rest))


def resampling_rows():
    rng = np.random.default_rng(3)
    vocabulary = ["Été", "dog", "CAT", "x9", "日本", "z" * 90, "a", "of", "the", "Über"]
    rows = [(n, " ".join(rng.choice(vocabulary, rng.integers(1, 60))) + ", end.") for n in range(60)]
    return rows + [(100, None), (101, ""), (102, " ,;"), (None, "dog " * 30), (103, "dog cat " * 40), (103, "dog cat " * 40)]


@pytest.mark.parametrize("clashing", [False, True])
def test_weights_and_draw_equal_plain_counting(spark, documents, clashing, monkeypatch):
    target = spark.createDataFrame([("the dog, the cat",), (None,), ("été of x9",)], "text string")
    rows, docs = resampling_rows(), documents(resampling_rows(), clashing)
    got = resampling.digest(docs, target).collect()
    assert sorted(str((str(r.doc_id), r.n_features, r.weight, r.score, r.rank)) for r in got) == plain_resample(rows, [
        "the dog, the cat", None, "été of x9"])
    drawn = resampling.resample(docs, target)
    assert drawn.columns == docs.columns
    assert drawn.count() == sum(r.rank is not None for r in got)


def test_a_text_longer_than_a_stretch_counts_alike():
    text = ("Words of é, many; " * 40 + "w" * 50 + " " * 300 + "end ").encode()
    data = np.frombuffer(text, np.uint8)
    _, single, _, pairs = resampling.feature_buckets(data, np.array([0, len(data)]))
    for size in (5, 64, 333):
        words, doubles = [], []
        for part, again in resampling.stretches(data, size):
            _, a, _, b = resampling.feature_buckets(part, np.array([0, len(part)]))
            words += a[int(again):].tolist()
            doubles += b.tolist()
        assert words == single.tolist() and doubles == pairs.tolist()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 1 << 20), min_size=1, max_size=40), st.integers(0, 1 << 32))
def test_bit_planes_give_exact_sums(counts, seed):
    rng = np.random.default_rng(seed)
    gains = rng.integers(-20_000, 20_000, resampling.BUCKETS)
    held = np.zeros((2, resampling.BUCKETS), np.int64)
    held[0, rng.integers(0, resampling.BUCKETS, len(counts))] = counts
    planes = resampling.to_planes(np.maximum(gains, 0)), resampling.to_planes(np.maximum(-gains, 0))
    assert resampling.sliced_sums(held, planes).tolist() == (held @ gains).tolist()


# --- collocations ---------------------------------------------------------------------------

@settings(max_examples=40, deadline=None)
@given(st.integers(2, 4), st.integers(0, 200), st.integers(0, 9), st.integers(0, 1 << 32))
def test_filters_hold_keys_and_counts_exactly(words, size, range_bits, seed):
    rng = np.random.default_rng(seed)
    ids = [rng.integers(1, rng.choice([3, 1 << 32]), size) for _ in range(words)]
    counts = rng.integers(1, 700, size)
    want = Counter()
    for *key, n in zip(*[i.tolist() for i in ids], counts.tolist(), strict=True):
        want[tuple(key)] += n
    keys = quotient_filter.permute(ids)
    assert [i.tolist() for i in quotient_filter.unpermute(*keys, words)] == [i.tolist() for i in ids]
    halves = [quotient_filter.cut(*quotient_filter.summed(*(k[part] for k in keys), counts[part]), words, range_bits)
              for part in (slice(None, size // 2), slice(size // 2, None))]
    got, ranges = Counter(), defaultdict(list)
    for number, data in [f for half in halves for f in half]:
        ranges[number].append(data)
    for filters in ranges.values():
        upper, lower, n, size_of_key = quotient_filter.merge(filters, range_bits)
        assert size_of_key == words and (np.diff(upper.astype(object)) >= 0).all()
        got.update(dict(zip(zip(*[i.tolist() for i in quotient_filter.unpermute(upper, lower, words)], strict=True), n.tolist(),
                            strict=True)))
    assert got == want


def plain_collocations(rows, min_count, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[a:a + size]) for a in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        held = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        longer = Counter()
        for p, a in held.items():
            for size in range(2, len(p)):
                for at in range(len(p) - size + 1):
                    longer[p[at:at + size]] = max(longer[p[at:at + size]], a)
        ranked = []
        for p, a in held.items():
            score, _, left, right = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                        for k in range(1, len(p)))
            if 100 * longer[p] < 80 * a:
                ranked.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, rank + 1, p.decode(), -a, left, right, n[lang], -score)
                for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def phrase_rows():
    rng = np.random.default_rng(11)
    vocabulary = ["New", "york", "city", "de", "la", "É", "日本", "a-b", "x\x00y", "of"]
    rows = [(["en", "fr", None, "und"][n % 4], "".join(
        w + rng.choice([" ", "  ", "\t", ", ", "\n", " "]) for w in rng.choice(vocabulary, rng.integers(0, 30), p=[.25, .2, .15] + [.4 / 7] * 7)))
        for n in range(120)]
    return rows + [("en", None), ("en", ""), (None, ".,;"), ("en", "New York City! " * 50), ("en", "x " * 500), ("fr", "De la " * 700)]


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 300, "min_range_bits": 0}, {"shard_bytes": 2000, "min_range_bits": 3}])
def test_phrases_equal_plain_counting(spark, sizes):
    rows = phrase_rows()
    docs = spark.createDataFrame([(n, t, lang, 1, "w") for n, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, f int, words string").repartition(3)
    for min_count, top in ((30, 2000), (6, 7)):
        got = collocations.collocations(docs, min_count, top, **sizes).collect()
        assert sorted(tuple(r) for r in got) == plain_collocations(rows, min_count, top)


def test_scores_pass_64_bits(spark):
    big = 6 * 10**12
    words = spark.createDataFrame([(1, "en", "a", big), (2, "en", "b", big + 1)], "id long, lang string, word string, f long")
    phrases = spark.createDataFrame([(2, 1, 2, 0, 0, big - 1)], "words int, w1 long, w2 long, w3 long, w4 long, f long")
    row = collocations.scored_phrases(words, phrases).first()
    assert (row.score, row.l, row.r) == (2_000_000 * (big - 1) // (2 * big + 1), big, big + 1)


def test_empty_tables(spark, documents):
    none, some = documents([]), documents([(1, "one two three")])
    target = spark.createDataFrame([], "text string")
    assert line_dedup.digest(none).count() == line_dedup.without_repeated_lines(none).count() == 0
    assert resampling.digest(none, target).count() == collocations.collocations(none).count() == 0
    assert [tuple(r) for r in resampling.digest(some, target).collect()][0][4] is None
    assert collocations.collocations(some).count() == 0
