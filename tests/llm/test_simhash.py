"""SimHash components against a plain all-pairs computation."""

import random

import pytest
import xxhash

from sedimenta.llm import simhash
from sedimenta.llm.components import connected_nodes


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace(
        "\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 200))) for _ in range(60)]
    texts = [*base, *base[:10], None, "", " \t\n", "One", "one", "TWO words", "two words", "É x y", "é x y"]
    for text in base[:20]:
        words = text.split()
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts.append(" ".join(rng.choices(vocabulary, k=20_000)))
    return texts


def test_components_equal_all_pairs(documents):
    texts = corpus()
    ids = list(range(1000, 1000 + len(texts)))
    rows = simhash.simhash_components(documents(list(zip(ids, texts)), True)).collect()
    prints = [plain_fingerprint(t) for t in texts]
    roots = plain_components(prints)
    least = {}
    for i, r in zip(ids, roots):
        least[r] = min(least.get(r, i), i)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{p:016x}", least[r]) for i, p, r in zip(ids, prints, roots)}


@pytest.mark.parametrize("bound", [1, 3, 1000])
def test_long_lists_lose_no_link(spark, bound):
    rng = random.Random(bound)
    centres = [rng.getrandbits(64) for _ in range(3)]
    prints = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for c in centres for _ in range(40)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame(list(zip(signed, range(len(prints)))), "fp long, doc_id long")
    found = {r.fp: r.component_id for r in simhash.fingerprint_classes(rows, list_bound=bound).collect()}
    roots = plain_components(prints)
    least = {}
    for i, r in enumerate(roots):
        least[r] = min(least.get(r, i), i)
    assert [found[p] for p in signed] == [least[r] for r in roots]


def test_one_of_each_group_stays(documents):
    docs = documents([(5, "a b c d"), (2, "a b c d"), (2, "a b c d"), (9, "quite another text"), (None, "a b c d"), (7, None)], True)
    kept = simhash.keep_one_of_each_component(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == ["2", "7", "9", "None"]
    assert simhash.keep_one_of_each_component(documents([])).count() == 0


def test_components_of_a_long_path_and_loops(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000), (2000, 2001), (2001, 2000), (2000, 2001)]
    rows = connected_nodes(spark.createDataFrame(edges, "src long, dst long")).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, groups.values())) == [2, 301]
    assert connected_nodes(spark.createDataFrame([], "src long, dst long")).count() == 0
