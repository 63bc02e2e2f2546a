"""Near duplicates among rows that share ids, or have none."""

from velostat.llm import simhash

SCHEMA = "doc_id bigint, text string"
TEXTS = [
    "the river runs slowly through the old town and under seven stone bridges before it meets the sea",
    "a recipe for bread needs flour water salt and yeast and a good deal of patience in the kitchen",
    "satellites circle the planet twice a day and send pictures of clouds to stations on the ground",
]


def test_unrelated_components_with_one_id_all_stay(spark):
    docs = spark.createDataFrame([(1, t) for t in TEXTS] + [(2, TEXTS[0]), (3, TEXTS[1].upper()), (9, TEXTS[2])], SCHEMA)
    assert sorted((r.doc_id, r.text) for r in simhash.drop_near_duplicates(docs).collect()) == sorted((1, t) for t in TEXTS)
    found = simhash.near_duplicates(docs).collect()
    assert len({r.root for r in found}) == len(TEXTS)
    assert {r.component_id for r in found} == {1}  # the smallest id that can be reached, in each of them


def test_one_of_linked_texts_without_ids_stays(spark):
    docs = spark.createDataFrame([(None, TEXTS[0]), (None, TEXTS[0].upper()), (None, TEXTS[1])], SCHEMA)
    kept = [r.text.lower() for r in simhash.drop_near_duplicates(docs).collect()]
    assert sorted(kept) == sorted(TEXTS[:2])
    prints = {f: r for f, r in ((r.fp, r.root) for r in simhash.near_duplicates(docs).collect())}
    assert len(prints) == 2


def test_near_copies_without_ids(spark):
    """Different fingerprints that are linked and all lack an id are one group."""
    words = [f"w{k}" for k in range(600)]
    base, other = " ".join(words), " ".join(words[:-1] + ["x"])
    docs = spark.createDataFrame([(None, base), (None, other)], SCHEMA)
    found = simhash.near_duplicates(docs).collect()
    assert len({r.fp for r in found}) == 2 and len({r.root for r in found}) == 1
    assert simhash.drop_near_duplicates(docs).count() == 1


def test_count_filter_and_longer_lists(spark):
    """Pairs in lists of two only, pairs in longer lists only, and pairs in both; links at 4 bits, none at 5;
    bit 63 counts like any other."""
    import numpy as np

    rng = np.random.default_rng(21)
    fps = set()
    for k in range(150):
        base = int(rng.integers(0, 1 << 64, dtype=np.uint64))
        places = [int(p) for p in rng.permutation(64)[:4]] + [63, 62, 7]
        other = base ^ sum(1 << p for p in set(places[:4]))  # 4 bits in up to 4 bytes
        far = base ^ 0x0101010101 << 8 * int(rng.integers(0, 4))  # 5 bits in 5 bytes
        top = base ^ 1 << 63 ^ 1
        fps |= {base, other, top} | ({far} if k % 2 else set())
        if k % 5 == 0:  # many that share three bytes with the base
            fps |= {base ^ (int(x) << 24) for x in rng.integers(1, 1 << 40, 8, dtype=np.uint64)}
    fps = np.array(sorted(fps), dtype=np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    label = np.arange(len(fps))
    while True:
        best = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (best == label).all():
            break
        label = best
    from velostat.llm.components import connected_components

    docs = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint")
    for distance, chunk in ((4, 1_000), (4, 3)):
        links = simhash.fingerprint_links(docs, distance, chunk)
        roots = {r.node: r.root for r in connected_components(links).collect()}
        got = [roots.get(int(x), int(x)) for x in fps.view(np.int64)]
        groups, known = {}, {}
        for g, x in zip(got, label.tolist()):
            assert groups.setdefault(g, x) == x and known.setdefault(x, g) == g
