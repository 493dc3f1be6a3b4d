"""Whole licences and file headers."""

from __future__ import annotations

from pathlib import Path

from loanpanel.llm import license_scan
from oracle_check import connect


def test_whole_texts_and_headers(spark):
    folder = Path(license_scan.__file__).parent / "licenses"
    texts = {p.stem: p.read_text("utf-8") for p in folder.glob("*.txt")}
    names = ["GPL-2.0", "GPL-3.0", "LGPL-2.1", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "Apache-2.0", "Unlicense", "Zlib", "ISC", "MIT"]
    header = (
        "/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public "
        "License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later "
        "version.\n *\n * more\n */\ncode"
    )
    rows = [(i, "Copyright (c) 2021 Somebody\n\n" + " ".join(texts[n].split("  "))) for i, n in enumerate(names)] + [(99, header)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(docs, license_scan.known_digests(spark)).collect()}
    assert [got[i].license for i in range(len(names))] == names
    assert got[99].license is None and got[99].licenses == "GPL-3.0-or-later"
    con = connect("/root/testdata/sf0.001")
    con.execute("CREATE OR REPLACE TEMP VIEW documents AS SELECT * FROM (VALUES " + ", ".join(
        f"({i}, '{t.replace(chr(39), chr(39) * 2)}')" for i, t in rows) + ") AS d(doc_id, text)")
    found = dict(con.execute(f"SELECT doc_id, license FROM ({license_scan.oracle()})").fetchall())
    assert found == {i: r.license for i, r in got.items()}
