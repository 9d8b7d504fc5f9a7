import hashlib

from pyspark.sql import functions as F

from tessera.llm import license_digests


def test_spellings_meet(spark):
    mit = license_digests.TEXTS["MIT"]
    rows = [
        (1, "Copyright (c) 2020 Ann\n" + mit.upper(), "MIT", ""), (2, mit.replace("sublicense", "sublicence").replace(" ", "\t  "), "MIT", ""),
        (3, mit + " more", None, ""), (4, "some words\nLicensed under the Apache Licence, Version 2.0!!\nmore", None, "Apache-2.0"),
        (5, "words\n\n(c) 1999 Bob\n" + license_digests.TEXTS["ISC"] + "\n \nend", None, "ISC"), (6, None, None, ""), (7, "", None, ""),
        (8, "Copyright 2001 someone\n© all\nAll rights reserved.", None, ""), (None, "GPLv3\nCC BY 4.0\nGPLv3", None, "CC-BY-4.0,GPL-3.0"),
        (10, "this work is licensed under the GNU General Public License, version 3.", "GPL-3.0", "GPL-3.0"), (11, "word " * 100_000, None, "")]
    df = spark.createDataFrame([(i, t) for i, t, *_ in rows], "doc_id long, text string").withColumn("unit", F.lit("x"))
    got = {r.doc_id: r for r in license_digests.scan(df).collect()}
    for i, _, known, notices in rows:
        quoted = [x for x in got[i].notices.split(",") if x]
        assert got[i].license == known, i
        assert set(filter(None, notices.split(","))) <= set(quoted) and got[i].n_notices == len(quoted), (i, quoted)
    assert got[6].digest == got[7].digest == hashlib.sha256(b"").hexdigest() and not got[11].notices and not got[3].notices


def test_rows_stay(odd, none):
    assert license_digests.scan(odd).count() == odd.count()
    assert license_digests.scan(none).count() == 0


def test_registry_has_no_clash(spark):
    known = license_digests.known_digests(spark)
    assert known.count() == known.select("unit").distinct().count() > 100


def test_whole_licences_are_known(spark):
    files = {"GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0",
             "Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0"}
    rows = [((license_digests.FILES / f"{v}.txt").read_text(), v) for v in files.values()]
    mit = license_digests.TEXTS["MIT"]
    parts = mit.replace("conditions:\n", "conditions:\n\n").replace("the Software.\nTHE", "the Software.\n\nTHE")
    rows += [(f"{title}\n\nCopyright (c) 2020 Ann\n\n{parts}", "MIT") for title in ("MIT License", "The MIT License", "The MIT License (MIT)")]
    bsd = (license_digests.FILES / "BSD-3-Clause.txt").read_text()
    rows += [("BSD 3-Clause License\n\nCopyright (c) 2020, Ann\nAll rights reserved.\n\n" + bsd, "BSD-3-Clause"),
             (bsd.replace("1.", "*").replace("2.", "*").replace("3.", "*"), "BSD-3-Clause")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_digests.scan(df).collect()}
    assert [got[i].license for i in range(len(rows))] == [k for _, k in rows]
    clause = "words\n\n" + parts.split("\n\n")[1] + "\n\nmore words"
    assert license_digests.scan(spark.createDataFrame([(1, clause)], "doc_id long, text string")).first().notices == "MIT"
