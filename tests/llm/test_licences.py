import textwrap

from placelake.llm import licences

MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated\n"
       "documentation files")


def found(docs):
    return {r["doc_id"]: (r["n_sentences"], r["identifiers"], r["licences"]) for r in licences.scan_licences(docs).collect()}


def test_references_and_ordered_sequences(make_docs):
    known = {v: k for k, v in licences.SENTENCES.items()}
    text = lambda *ids: "Some prose. " + ". Between! ".join(known[i].upper() for i in ids) + ".\nMore"
    rows = found(make_docs([
        (1, "x\nReleased under the MIT License.\ny"), (2, "Licensed under the Apache License, Version 2.0."),
        (3, "This work is licensed under the GNU General Public License, version 3. Licensed under CC BY-NC 4.0."),
        (4, text("mit-grant", "mit-notice", "mit-warranty")), (5, text("mit-notice", "mit-grant", "mit-warranty")),
        (6, text("bsd-source", "reserved", "bsd-binary")), (7, text("bsd-source", "bsd-binary", "mit-ref")),
        (8, "We released under the MIT License last year."),
    ]))
    assert rows[1] == (3, ["mit-ref"], ["MIT"]) and rows[2] == (1, ["apache-ref"], ["Apache-2.0"])
    assert rows[3][1:] == (["gpl3-ref", "cc-by-nc-ref"], ["CC-BY-NC-4.0", "GPL-3.0"])
    assert rows[4][2] == ["MIT"] and rows[5][2] == [] and rows[6][2] == []
    assert rows[7][2] == ["BSD-2-Clause", "MIT"] and rows[8] == (1, [], [])


def test_wrapped_texts(make_docs):
    known = {v: k for k, v in licences.SENTENCES.items()}

    def wrapped(ids, prefix="", gap="\n\n"):
        return gap.join("\n".join(prefix + x for x in textwrap.wrap(known[i].capitalize() + ".", 60)) for i in ids)

    rules = {name: seq for name, seq in licences.RULES}
    rows = [(k, "Copyright 2020\n\n" + wrapped(seq, p, g)) for k, (seq, p, g) in enumerate(
        [(seq, p, g) for seq in rules.values() for p, g in (("", "\n\n"), (" * ", "\n *\n"), ("# ", "\n"))])]
    got = found(make_docs([*rows, (900, MIT + "\nand so on"), (901, wrapped(["bsd-source", "bsd-binary"])),
                           (902, known["mit-grant"].replace(" to deal", "\n\nto deal"))]))
    for k, name in enumerate(name for name in rules for _ in range(3)):
        assert got[k][2] == [name], (name, rows[k], got[k])
    assert got[900][1:] == ([], []) and got[901][2] == ["BSD-2-Clause"] and got[902][1] == []


def test_edges(edge_docs, no_docs):
    rows = licences.scan_licences(edge_docs).collect()
    assert len(rows) == edge_docs.count() and all(r["licences"] == [] for r in rows)
    assert {r["doc_id"]: r["n_sentences"] for r in rows}[1] == 0
    assert licences.scan_licences(no_docs).count() == 0


def test_very_many_lines_and_a_very_long_one(make_docs):
    end = "\nLicensed under CC0 1.0.\n"
    rows = found(make_docs([(1, "a" + "\n" * 1_000_000 + end), (2, "a\n" + "// \n" * 300_000 + end), (3, "word " * 2_000_000 + end),
                            (4, "." * 3_000_000 + "x" + end), (5, "a\n" + "#.!\n" * 200_000 + end), (6, "x." * 1_000_000 + "\n" * 3 + end)]))
    assert all(r[2] == ["CC0-1.0"] for r in rows.values()) and len(rows) == 6
    assert rows[1][0] == 2 and rows[2][0] == 2


def test_one_line_of_50_mb(spark):
    docs = spark.range(1).selectExpr("id AS doc_id", "concat(repeat('many words! ', 4500000), '\\n', 'licensed under cc by 4.0') AS text")
    row = licences.scan_licences(docs).first()
    assert row["licences"] == ["CC-BY-4.0"] and row["n_sentences"] == 4_500_001
