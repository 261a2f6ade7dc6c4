import random

import pytest

from placelake.llm import decontamination as d

WORDS = ["river", "stone", "amber", "quiet", "lantern", "meadow", "copper", "harbor", "violet", "thunder", "orchard", "velvet",
         "compass", "glacier", "saffron", "timber", "willow", "marble", "canyon", "feather"]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(100)) for _ in range(n))


def plain_distance(item, text):
    """The smallest edit distance to a part of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_edit_distance_equals_the_full_table():
    rng = random.Random(1)
    for _ in range(200):
        item = bytes(rng.choice(b"abc ") for _ in range(rng.randrange(1, 90)))
        text = bytes(rng.choice(b"abc ") for _ in range(rng.randrange(0, 120)))
        assert d.edit_distance(item, text) == plain_distance(item, text)


@pytest.mark.parametrize("ratio", [0.0, 0.04, 0.08])
def test_recall_of_edited_items(ratio):
    rng = random.Random(2)
    items = [sentence(rng, rng.randrange(8, 45)) for _ in range(60)]
    index = d.Index(list(range(60)), items)
    found = 0
    for k, item in enumerate(items):
        chars = list(item)
        for _ in range(int(ratio * len(d.normalised(item)))):
            chars[rng.randrange(3, len(chars))] = rng.choice("etaoinshr")
        text = f"{sentence(rng, 40)}. {''.join(chars).upper()}! {sentence(rng, 40)}"
        hits = {i: distance for i, distance, _ in index.matches([text])[0]}
        found += k in hits
        assert set(hits) <= {k}
    assert found >= 0.98 * 60


@pytest.mark.parametrize("alphabet", ["\u6c34\u706b\u6728\u91d1\u571f\u65e5\u6708\u5c71\u5ddd\u7530", "\u0e01\u0e02\u0e04\u0e07\u0e08\u0e0a\u0e0d\u0e14", "abcdefghij"])
def test_items_inside_unspaced_runs(alphabet):
    rng = random.Random(5)
    run = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    items = [run(rng.randrange(40, 90)) for _ in range(20)]
    index = d.Index(list(range(20)), items)
    for k, item in enumerate(items):
        changed = item[:20] + ("x" if item[20] != "x" else "y") + item[21:]
        for text in (run(70) + item + run(50), run(7) + changed + run(31)):
            assert [i for i, _, _ in index.matches([text])[0]] == [k]
    assert index.matches([run(500)]) == [[]]


def test_short_items_are_found_as_whole_words():
    index = d.Index([1, 2, 3, None, 5], ["Grey owl!", "\u6c34\u706b", "grey", "grey owl", " ?"])
    held = lambda text: [(i, n) for i, distance, n in index.matches([text])[0]]
    assert held("a grey OWL, here") == [(1, 8), (3, 4), (None, 8)] and held("greyowl grey-owls") == [(3, 4)]
    assert held("\u6728\u6c34\u706b\u6728") == [(2, 6)] and held("greying") == [] == held("")


def test_keys_get_shorter_where_long_ones_miss(monkeypatch):
    rng = random.Random(6)
    items = [sentence(rng, 30) for _ in range(10)]
    monkeypatch.setattr(d, "_MOST_KEYS", 24)
    index = d.Index(list(range(10)), items)
    assert all(len(keys[0]) < 5 for part in index.classes for keys in part.samples)
    assert all(sum(map(len, part.samples)) >= 6 for part in index.classes)
    monkeypatch.setattr(d, "_MOST_KEYS", 1)
    with pytest.raises(ValueError, match="recall"):
        d.Index(list(range(10)), items)


def test_a_very_long_item_needs_no_table():
    rng = random.Random(7)
    item = sentence(rng, 6000)
    index = d.Index([1, 2], [item, sentence(rng, 12)])
    assert [m[:2] for m in index.matches([f"{sentence(rng, 9)} {item} {sentence(rng, 9)}"])[0]] == [(1, 0)]


def test_clean_texts_hold_nothing():
    rng = random.Random(3)
    index = d.Index(list(range(30)), [sentence(rng, 20) for _ in range(30)])
    assert not any(index.matches([sentence(rng, 300) for _ in range(50)]))


def test_several_indexes_find_what_one_finds(spark, make_docs):
    rng = random.Random(4)
    items = [sentence(rng, 15) for _ in range(12)]
    bench = spark.createDataFrame(list(enumerate(items)) + [(90, None), (91, ""), (92, "short")], "item_id long, text string")
    docs = make_docs([(k, f"{sentence(rng, 20)} {item} {sentence(rng, 9)}") for k, item in enumerate(items)] + [(50, sentence(rng, 50))])
    one = sorted(map(tuple, d.contaminated(docs, bench).collect()))
    assert [r[:3] for r in one] == [(k, k, 0) for k in range(12)]
    assert sorted(map(tuple, d.contaminated(docs, bench, index_bytes=300).collect())) == one
    clean = d.clean(docs, bench, index_bytes=300)
    assert clean.columns == docs.columns and [r["doc_id"] for r in clean.collect()] == [50]


def test_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "w5x5 w6x6 w7x7 w8x8 w9x9 w10x10"), (None, "same row twice word for word")], "item_id long, text string")
    found = sorted((r["doc_id"], r["item_id"] or -1) for r in d.contaminated(edge_docs, bench).collect())
    assert found == [(4, 1), (5, -1), (5, -1)]
    assert d.contaminated(no_docs, bench).count() == 0
    empty = bench.filter("false")
    assert d.contaminated(edge_docs, empty).count() == 0 and d.clean(edge_docs, empty).count() == edge_docs.count()


def test_edited_passages_equal_a_full_scan(spark, make_docs):
    rng = random.Random(8)
    items = [sentence(rng, rng.randrange(3, 9)) for _ in range(8)] + ["short one", "x"]
    texts = []
    for k in range(24):
        chars = list(items[k % 8])
        for _ in range(k // 8 * 2):
            chars[rng.randrange(1, len(chars))] = rng.choice("etaoinshr")
        texts.append(f"{sentence(rng, 6)} {''.join(chars)} {sentence(rng, 6)}")
    texts += ["a short one here", "shorty ones", "x", sentence(rng, 20), "", None]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in d.contaminated(make_docs(list(enumerate(texts))), bench).collect()}
    want = set()
    for t, text in enumerate(texts):
        raw = d.normalised(text or "")
        for k, item in enumerate(map(d.normalised, items)):
            distance = plain_distance(item, raw) if len(item) >= 20 else 0 if b" " + item + b" " in b" " + raw + b" " else 99
            if distance <= d.allowed_edits(len(item), 0.08):
                want.add((t, k, distance))
    assert got == want and len(got) >= 18


def test_query_finds_every_exact_passage(spark):
    from placelake.llm import queries

    sf = "/root/testdata/sf0.001"
    items = {r["item_id"]: d.normalised(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = {(r["doc_id"], k) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for k, item in items.items() if item in d.normalised(r["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op1_decontamination(spark, sf).collect()}
    assert want <= got
