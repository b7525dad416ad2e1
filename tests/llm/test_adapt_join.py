import random
import re
from collections import defaultdict

import edge_cases as E
import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from streetpulse.llm import adapt_join as A
from streetpulse.llm.components import components, merged_labels


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """[(doc_id, n, component)] by comparing all pairs of rows."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if same_id or both and 100 * both >= 75 * (len(a) + len(b) - both):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {k: min([x for x in v if x is not None], default=None) for k, v in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=repr)


def got(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in A.jaccard_components(spark, df).collect()), key=repr)


def family(rng, n, words=120, edits=3):
    base = [f"v{rng.randrange(5000)}" for _ in range(words)]
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            k = rng.randrange(len(w))
            w[k:k + rng.randrange(2)] = [f"e{rng.randrange(9999)}"] * rng.randrange(2)
        yield " ".join(w)


def corpus(seed):
    rng = random.Random(seed)
    texts = []
    for size in (2, 5, 40):
        texts += list(family(rng, size, rng.choice([8, 60, 200]), 6))
    chain = [f"c{i}" for i in range(400)]                                   # linked only from neighbour to neighbour
    texts += [" ".join(chain[i * 9:i * 9 + 90]) for i in range(20)]
    passage = [f"p{i}" for i in range(60)]                                   # shared by texts that are not similar
    texts += [" ".join([f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(10, 90))] + passage) for _ in range(40)]
    texts += [" ".join(passage)] * 3 + [" ".join(passage).upper()] + ["one two", "One\tTWO", "one", "", None, " \n"]
    rng.shuffle(texts)
    ids = rng.sample(range(10_000), len(texts))
    return list(zip(ids, texts))


def test_components_equal_brute_force(spark):
    for seed in range(3):
        rows = corpus(seed)
        assert got(spark, rows) == brute(rows)


def test_edge_cases_equal_brute_force(spark):
    rows = [(r[0], r[1]) for r in E.ROWS] + [(None, "x y z"), (None, "X y  z"), (20, "k l m"), (20, "a b c d e f g")]
    assert got(spark, rows) == brute(rows)


def test_one_of_each(spark):
    df = E.with_extra(E.documents(spark))
    out = A.one_of_each(spark, df)
    assert out.columns == df.columns
    kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert kept == sorted([(1, E.TEXT), (4, None), (5, ""), (6, " \t\n\x0b "), (None, None), (7, E.LONG),
                           (8, "x" * 200_000), (9, "9" * 100_000 + "@"), (10, "one two three")], key=repr)
    assert A.one_of_each(spark, E.empty(spark)).count() == 0
    assert A.jaccard_components(spark, E.empty(spark)).count() == 0


def test_hashes_do_not_depend_on_blocks():
    text = E.LONG[:40_000] + " Ünïcode WÖRDS " + "y" * 300 + " " + "y" * 301
    assert np.array_equal(A.shingle_hashes(text), A.shingle_hashes(text, block=7))
    assert len(A.shingle_hashes(text)) == len(shingles(text))
    assert np.array_equal(A.shingle_hashes("A b\tC d E f"), A.shingle_hashes("a B c  D e F"))


def test_prefixes_keep_the_lemma():
    """Prefixes of similar sets share what the candidate test asks for, whatever the counters say."""
    rng = np.random.default_rng(5)
    seen = set()
    for _ in range(300):
        counts = rng.integers(1, rng.choice([2, 50, 5000]), 1 << A.SKETCH_BITS)
        n = int(rng.integers(1, 200))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        drop = rng.integers(0, max(1, len(a) // 5) + 1)
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 1 << 63, drop // 2, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        (la, pa), (lb, pb) = (A.chosen_prefix(x, counts, verify_cost=rng.choice([0.1, 4, 60])) for x in (a, b))
        seen.add(la)
        differ = sum(bin(x & (1 << 64) - 1 ^ y & (1 << 64) - 1).count("1")
                     for x, y in zip(A.parity_bits(a), A.parity_bits(b)))
        assert differ <= len(np.setxor1d(a, b)) <= len(a) + len(b) - 2 * -(-75 * (len(a) + len(b)) // 175)
        overlap, least = -(-75 * (len(a) + len(b)) // 175), min(la, lb)
        early = [x[:len(x0) - overlap + least] for x, x0 in ((pa, a), (pb, b))]
        assert [len(e) for e in early] == [len(a) - overlap + least, len(b) - overlap + least]
        assert len(np.intersect1d(*early)) >= least
        assert len(a) - len(pa) == -(-75 * len(a) // 100) - la
    assert len(seen) > 3


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (300, 299), (299, 300)]
    df = spark.createDataFrame(links, "a long, b long")
    labels = {r.node: r.label for r in components(df).collect()}
    assert all(labels[i] == 0 for i in range(61)) and all(labels[100 + i] == 100 for i in range(40)) and labels[300] == 299
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=12), min_size=1, max_size=3))
def test_labels_merged_in_rounds_are_those_of_all_links(spark, rounds):

    frames = [spark.createDataFrame(r, "a long, b long") for r in rounds]
    labels = components(frames[0])
    for f in frames[1:]:
        labels = merged_labels(labels, f)
    parent = list(range(26))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in (e for r in rounds for e in r):
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.node: r.label for r in labels.collect()}
    assert all(got.get(i, i) == find(i) for i in range(26))


def test_sketch_summed_as_a_tree(spark):
    """The counters are the same whatever the number of blocks a group takes."""
    rows = [(i, " ".join(f"w{(i * 7 + j) % 91}" for j in range(30))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    measured = docs.mapInPandas(A._measure, A.MEASURED).persist()
    flat = A._sketch(measured)
    assert flat.sum() > 0 and all((A._sketch(measured, k) == flat).all() for k in (2, 4))
    measured.unpersist()
