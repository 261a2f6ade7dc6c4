import random
import re
from collections import Counter

from placelake.llm import quality_rules as q

PROSE = " ".join(f"word{k}" for k in range(60))


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    marked = {j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(k, k + 3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:k] for k, x in enumerate(lines)), len(marked))


def judged(docs, scratch, **limits):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return {(r["_id"], r["_h"]): tuple(r[n] for n in names) + (r["base_failed"], r["kept"])
            for r in q.judge(docs, scratch, **limits).collect()}


def test_measures_equal_brute_force():
    for text in ["", " \n\t", "a b c a b c", "a b c\na b c\n\n x # <|>", "ÄÖ ü\x0bß\x0c x\r\ny", "a a a a a", " a b c",
                 "one two\nthree\n" * 40, "x", "a b", "\x1fa\x00b c"]:
        assert q.measures(text)[:5] == brute(text), text


def test_edges(edge_docs, no_docs, scratch):
    rows = judged(edge_docs, scratch)
    assert len(rows) == 10  # the repeated row is one
    assert q.judge(no_docs, q.Scratch(no_docs.sparkSession, "none")).count() == 0
    kept = q.keep_good(edge_docs, q.Scratch(edge_docs.sparkSession, "k"))
    assert kept.columns == edge_docs.columns
    assert [r["doc_id"] for r in kept.collect()] == [4]


def test_frequent_lines_go_and_depleted_documents_too(make_docs, scratch):
    own = [" ".join(f"d{d}w{k}" for k in range(60)) for d in range(6)]
    shared = " ".join(f"shared{k}" for k in range(55))
    docs = make_docs([(d, f"{own[d]}\nCommon  line\n{own[d][::-1]}", "en", "h") for d in range(6)]
                     + [(10 + d, f"{shared}\nd{d}", "en", "h") for d in range(6)] + [(20, own[0] + "\ncommon line", "en", "other")])
    kept = {r["doc_id"]: r["text"] for r in q.keep_good(docs, scratch, max_docs=4).collect()}
    assert sorted(kept) == [0, 1, 2, 3, 4, 5, 10, 20]
    assert all(("Common" in kept[d]) == (d == 0) and own[d] in kept[d] for d in range(6))  # the first document keeps it
    assert "common line" in kept[20]  # another host


def test_exact_copies_count_once_and_edited_ones_apart(make_docs, scratch, spark):
    text = "\n".join(" ".join(f"l{n}w{k}" for k in range(12)) for n in range(8))
    few = [(d, text.replace("l3w4", f"edit{d}")) for d in range(5)] + [(100 + d, text) for d in range(60)]
    rows = judged(make_docs(few), scratch, max_docs=10)
    assert sum(r[-1] for r in rows.values()) == len(rows) == 65
    many = [(d, text.replace("l3w4", f"edit{d}")) for d in range(30)]
    rows = judged(make_docs(many), q.Scratch(spark, "many"), max_docs=10)
    assert [i for (i, _), r in rows.items() if r[-1]] == [0]  # of a template, the first document is left


def test_one_own_line_makes_a_document(make_docs, scratch):
    shared = [" ".join(f"s{n}w{k}" for k in range(12)) for n in range(20)]
    own = {"a": "this article was last changed by editor number {} of the desk", "b": "{}"}
    docs = make_docs([(100 * k + d, "\n".join([*shared, line.format(d)]), "en", host) for k, (host, line) in enumerate(own.items()) for d in range(60)])
    got = {r["_id"]: set(r["cut"] or ()) for r in q.judge(docs, scratch, max_docs=10).collect()}
    lines = {q.line_hash(x) for x in shared}
    assert all(cut == (set() if i in (0, 100) else lines) for i, cut in got.items()) and len(got) == 120


def test_mostly_shared_lines_equal_a_count_of_all_documents(make_docs, scratch):
    rng = random.Random(4)
    shared = [" ".join(f"s{n}w{k}" for k in range(12)) for n in range(20)]
    vocabulary = ["of", "the", "and", "to", "in"] * 40 + [f"v{k}" for k in range(400)]
    texts = {}
    for d in range(180):  # hosts: a short own line, a long one of common words, a text of its own with a part of the shared lines
        own = [f"own {d}"] if d < 60 else [" ".join(rng.choices(vocabulary, k=12))] if d < 120 else [" ".join(rng.choices(vocabulary, k=400))]
        lines = (shared if d < 120 else rng.sample(shared, 8)) + own
        rng.shuffle(lines)
        texts[d] = (f"h{d // 60}", lines)
    docs = make_docs([(d, "\n".join(lines), "en", host) for d, (host, lines) in texts.items()])
    count = Counter((host, line) for host, lines in texts.values() for line in set(lines))
    first = {(host, line): d for d, (host, lines) in sorted(texts.items(), reverse=True) for line in lines}
    got = {r["_id"]: (set(r["cut"] or ()), r["kept"]) for r in q.judge(docs, scratch, max_docs=10).collect()}
    for d, (host, lines) in texts.items():
        cut = [x for x in lines if count[host, x] > 10 and d > first[host, x]]
        left = sum(len(x.split()) for x in lines if x not in cut)
        assert got[d][0] == {q.line_hash(x) for x in cut}
        assert got[d][1] == (left >= 0.2 * sum(len(x.split()) for x in lines))


def test_lower_case_and_spaces_do_not_matter():
    assert q.line_hash("A  b\tC") == q.line_hash("a b c") != q.line_hash("a bc")
