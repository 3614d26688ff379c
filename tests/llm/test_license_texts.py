"""Real license texts, notices and identifiers, wrapped and among prose."""

from aerocube.llm import licenses

FULL = dict(licenses.FULL_TEXTS)
MIT, GPL = FULL["MIT"].replace("<year> <owner>", "2019 Some Firm Ltd."), FULL["GPL-3.0"]


def scan(spark, rows):
    df = spark.createDataFrame(rows, "path string, text string").repartition(2)
    return {r["path"]: (r["license"], r["origin"], r["license_dir"]) for r in licenses.scan_licenses(df).collect()}


def test_license_files_of_any_length_are_inherited_from(spark):
    prose = "long " + "words of code " * 300 + "\nReleased under the MIT License.\n"
    rows = [(f"{i}/LICENSE", t) for i, t in FULL.items()] + [(f"{i}/src/x", "code") for i in FULL]
    rows += [("mit/COPYING", MIT), ("mit/a/b", "code"), ("plain/terms.txt", GPL), ("plain/x", "code"), ("readme/LICENSE.md", prose), ("readme/x", "code"), ("not/x", prose), ("not/y", "code"), ("code/license.py", prose), ("code/y", "code")]
    got = scan(spark, rows)
    for i in FULL:
        assert got[f"{i}/LICENSE"] == (i, "own", None) and got[f"{i}/src/x"] == (i, "inherited", i)
    assert got["mit/a/b"] == ("MIT", "inherited", "mit") and got["plain/x"] == ("GPL-3.0", "inherited", "plain")
    assert got["readme/x"] == ("MIT", "inherited", "readme")
    assert got["not/x"][:2] == got["code/license.py"][:2] == ("MIT", "own") and got["not/y"] == got["code/y"] == (None, None, None)


def test_headers(spark):
    code = "\n\nint main() { return 0; }\n" * 200
    comment = lambda t, mark: "\n".join(f"{mark} {x}".rstrip() for x in t.splitlines())
    notice = GPL[GPL.index("    This program is free software: you") : GPL.index("Also add information")]
    apache = FULL["Apache-2.0"][FULL["Apache-2.0"].index("   Licensed under the Apache License") :]
    permission = " ".join(MIT[MIT.index("Permission is") : MIT.index("The above")].split())
    want = {
        "MIT": ["SPDX-License-Identifier: MIT", "// SPDX-License-Identifier: MIT" + code, "MIT License", permission, f"some words\n{permission}\nmore", comment(MIT, "//") + code, "/*\n" + MIT + "*/" + code, "Prose comes first. Released\nunder the MIT License. And more prose\nfollows it."],
        "Apache-2.0": ["<!-- SPDX-License-Identifier: Apache-2.0 -->", comment(apache, "#") + code, "Apache License\n  Version 2.0, January 2004"],
        "GPL-3.0": [comment(notice, " *") + code, "        GNU GENERAL PUBLIC LICENSE\n           Version 3, 29 June 2007"],
        "MIT OR Apache-2.0": ["# SPDX-License-Identifier: MIT OR Apache-2.0\nimport x"],
        "BSD-2-Clause": [comment(FULL["BSD-2-Clause"], "//") + code],
        "BSD-3-Clause": [comment(FULL["BSD-3-Clause"], "//") + code],
        None: ["a license to drive", "Copyright 2020 someone else entirely. All rights reserved.", "the license text is missing " + "x y z " * 2000],
    }
    rows = [(f"d{n}/{i}/f.c", t, i) for i, ts in want.items() for n, t in enumerate(ts)]
    got = scan(spark, [r[:2] for r in rows])
    assert {p: got[p][0] for p, _, _ in rows} == {p: i for p, _, i in rows}


def test_a_tag_speaks_for_its_file_only(spark):
    got = scan(spark, [("a/__init__.py", "# SPDX-License-Identifier: MIT\n"), ("a/x", "code")])
    assert got == {"a/__init__.py": ("MIT", "own", None), "a/x": (None, None, None)}
