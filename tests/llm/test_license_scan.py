import hashlib

from threadloom.llm import license_scan as ls


def scan(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS digest", "2 AS canon")
    return sorted(((r.doc_id, r.license_id, r.notices, r.notice_ids) for r in ls.scan_licenses(df).collect()), key=repr)


def test_whole_texts_and_lines(spark):
    mit = "Copyright (c) 2020 Somebody\n\n" + ls.MIT.upper().replace(", ", " ,\n   ").replace('"', "'")
    rows = [(1, mit), (2, "Released under the MIT Licence!"), (3, "text\n  * licensed under the apache license, version 2.0\nmore"),
            (4, "Released under the MIT License. And more."), (5, None), (6, ""), (None, "Licensed under CC-BY NC 4.0"), (7, "x " * 200_000)]
    assert scan(spark, rows) == sorted([
        (1, "MIT", 0, ""), (2, "MIT", 1, "MIT"), (3, None, 1, "Apache-2.0"), (4, None, 0, ""), (5, None, 0, ""), (6, None, 0, ""),
        (None, "CC-BY-NC-4.0", 1, "CC-BY-NC-4.0"), (7, None, 0, "")], key=repr)


def test_license_files_as_they_are_shipped(spark):
    texts = {r.license_id: r.text for r in ls.license_texts(spark).collect()}
    mit = "MIT License\n\nCopyright (c) 2020 Somebody\nCopyright The Authors\nAll rights reserved.\n\n" + ls.MIT
    wrapped = mit.replace("OR COPYRIGHT HOLDERS", "OR\nCOPYRIGHT HOLDERS")
    isc = "ISC License (ISC)\n\nCopyright (c) 2004, X\n\n" + ls.KNOWN["ISC"][0].replace("PERMISSION", "Permission")
    bsd = "BSD 3-Clause License\n\nCopyright (c) 2019, X\nAll rights reserved.\n\n" + texts["BSD-3-Clause"]
    apache = texts["Apache-2.0"]
    short = apache[:apache.index("END OF TERMS") + len("END OF TERMS AND CONDITIONS")]
    filled = apache.replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2020 The Authors")
    assert filled != apache
    files = [(mit, "MIT"), (wrapped, "MIT"), (isc, "ISC"), (bsd, "BSD-3-Clause"), (apache, "Apache-2.0"), (short, "Apache-2.0"),
             (filled, "Apache-2.0"), (texts["GPL-3.0"], "GPL-3.0"), (texts["MPL-2.0"], "MPL-2.0"), (bsd + "\nmore", None),
             ("MIT License", None), ("MIT License\nCopyright The Authors", None), ("All rights reserved.\n\n", None)]
    got = scan(spark, [(i, t) for i, (t, _) in enumerate(files)])
    assert [r[1] for r in sorted(got)] == [name for _, name in files]


def test_a_table_of_texts(spark):
    texts = spark.createDataFrame([("Own-1", "Own License\n\nCopyright (c) 2000 Y\nDo what you like.")], "license_id string, text string")
    df = spark.createDataFrame([(1, "Copyright Z\nDo what  you like")], "doc_id bigint, text string")
    assert ls.scan_licenses(df, texts=texts).first().license_id == "Own-1"


def test_digest_of_the_canonical_text(spark):
    df = spark.createDataFrame([(1, "(c) 2019 X\nSome,  LICENCE\n\n text.")], "doc_id bigint, text string")
    assert ls.scan_licenses(df).first().canonical_sha256 == hashlib.sha256(b"some license text").hexdigest()


def test_empty_table(spark):
    assert scan(spark, []) == []
