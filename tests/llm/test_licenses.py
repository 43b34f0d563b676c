import duckdb
import pytest

from payx.llm import licenses, queries


def found(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [tuple(r)[1:] for r in licenses.scanned(df).orderBy("doc_id").collect()]


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    rel = con.sql(licenses.oracle())
    assert sorted(map(str, rel.fetchall())) == sorted(str(tuple(r[c] for c in rel.columns)) for r in queries.op9_licenses(spark, sf_dir).collect())


@pytest.mark.parametrize(
    ("text", "license", "known"),
    [
        ("Licensed under the Apache License, Version 2.0.", "Apache-2.0", 1),
        ("Some text. Released under the MIT License. More.", "MIT", 1),
        ("All rights reserved.\nLicensed under CC BY-NC 4.0.", "CC-BY-NC-4.0", 2),
        ("All rights\nreserved", None, 0),
        ("all RIGHTS   reserved!", None, 1),
        ("This is not licensed under the MIT License.", None, 0),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\nx.\nNeither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "BSD-3-Clause", 2),
        ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "BSD-2-Clause", 1),
        (None, None, 0),
        ("", None, 0),
    ],
)
def test_rules(spark, text, license, known):
    n_sentences, n_known, ids, got, n = found(spark, text)[0]
    assert (got, n_known) == (license, known) and (n > 0) == (license is not None)


def test_order_of_sentences_counts(spark):
    grant, notice = licenses.SENTENCES["mit-grant"][0], licenses.SENTENCES["mit-notice"][0]
    assert found(spark, f"{grant}.\n{notice}.")[0][3] == "MIT"
    assert found(spark, f"{notice}.\n{grant}.")[0][3] is None


HEADERS = [
    ("MIT License", "MIT"), ("The MIT License", "MIT"), ("License: MIT", "MIT"), ("# License: Apache-2.0", "Apache-2.0"), ("ISC", None), ("The ISC License", "ISC"), ("SPDX-License-Identifier: MIT", "MIT"), ("/* SPDX-License-Identifier: GPL-2.0-only */", "GPL-2.0"), ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"), ("# SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1"),
    ("SPDX-License-Identifier: AGPL-3.0-only", "AGPL-3.0"), ("BSD 3-Clause License", "BSD-3-Clause"), ("A BSD 3-Clause License", "BSD-3-Clause"), ("The 3-Clause BSD License", "BSD-3-Clause"), ("Apache License 2.0", "Apache-2.0"), ("Mozilla Public License Version 2.0", "MPL-2.0"), ("License: BSD-2-Clause", "BSD-2-Clause"), ("All rights reserved.", None), ("my license", None), ("We like the MIT License a lot.", None),
]


def test_titles_and_tags(spark):
    assert [(t, r[3]) for (t, _), r in zip(HEADERS, found(spark, *[t for t, _ in HEADERS]), strict=True)] == HEADERS


def test_rules_take_their_sentences(spark):
    two = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
    three = two + "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
    four = three + "All advertising materials mentioning features or use of this software must display the following acknowledgement:\n"
    texts = [two, three, four, "All rights reserved.\n" + three, three + "License: BSD-2-Clause", "All rights reserved.", three + "License: MIT", "MIT License\n\n" + MIT]
    assert [(r[3], r[4]) for r in found(spark, *texts)] == [("BSD-2-Clause", 1), ("BSD-3-Clause", 1), ("BSD-4-Clause", 1), ("BSD-3-Clause", 1), ("BSD-3-Clause", 2), (None, 0), ("BSD-3-Clause", 2), ("MIT", 1)]
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    texts += [t for t, _ in HEADERS]
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    rel = con.sql(licenses.oracle())
    df = licenses.scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(map(str, rel.fetchall())) == sorted(str(tuple(r[c] for c in rel.columns)) for r in df.collect())


def test_no_python_in_the_plan(spark, sf_dir):
    plan = licenses.scanned(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_odd_repeated_and_empty(odd, repeated, empty):
    assert licenses.scanned(odd).count() == odd.count()
    assert licenses.scanned(repeated).count() == repeated.count()
    assert licenses.scanned(empty).count() == 0


MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
"""
GPL = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
WRAPPED = [(MIT, "MIT", "mit-grant mit-notice"), (APACHE, "Apache-2.0", "apache-grant apache-copy"), (GPL, "GPL-2.0", "gpl-grant-2"), (GPL.replace("version 2", "version 3"), "GPL-3.0", "gpl-grant-3"), (BSD, "BSD-3-Clause", "bsd-grant bsd-binary bsd-endorse")]
WRAPPED += [
    (MIT.replace("Copyright", "MIT License\n\nCopyright"), "MIT", "named:MIT mit-grant mit-notice"),
    ("                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   1. Definitions.\n", "Apache-2.0", "apache-title"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation\n\n                            Preamble\n\n  The GNU General Public License is a free, copyleft license for\nsoftware and other kinds of works.\n", "GPL-3.0", "gpl-title-3 gpl-preamble-3"),
    (GPL.replace("This program", "This library").replace("General", "Lesser General").replace("version 2", "version 2.1"), "LGPL-2.1", "lgpl-grant-2"),
    (GPL.replace("General", "Affero General").replace("version 2", "version 3"), "AGPL-3.0", "agpl-grant"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.\n", "MPL-2.0", "mpl-grant"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n", "ISC", "isc-grant"),
]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "\t", "\r"])
def test_wrapped_headers(spark, mark):
    wrap = (lambda t: t.replace("\n", "\r\n")) if mark == "\r" else lambda t: "".join(f"{mark}{x}\n" for x in t.split("\n"))
    got = found(spark, *[wrap(t) for t, _, _ in WRAPPED])
    assert [(r[3], r[2]) for r in got] == [(license, ids) for _, license, ids in WRAPPED]


def test_names_inside_sentences_and_line_ends(spark):
    texts = ["This file is licensed under the MIT License.", "The source code in question is released under the\nMIT License; see LICENSE for more.", "this project is not licensed under the MIT License", "A line that is long enough to be full goes before\nAll rights reserved\nand another one follows", "Copyright 2020 The Authors. All rights\nreserved.", "a paragraph that ends without a stop: all rights\n\nreserved"]
    assert [r[3] for r in found(spark, *texts)] == ["MIT", "MIT", None, None, None, None]


def test_names_and_tags(spark):
    texts = ["// SPDX-License-Identifier: GPL-2.0", "Distributed under the Boost Software License, Version 1.0.", "available under the LGPL v2.1", "The things that are not what is licensed under the MIT license.", "This is not what is licensed under the MIT license.", "This data is published under CC-BY-SA 4.0."]
    assert [r[3] for r in found(spark, *texts)] == ["GPL-2.0", "BSL-1.0", "LGPL-2.1", None, None, "CC-BY-SA-4.0"]


def test_sql_reads_wrapped_sentences_alike(spark):
    texts = [mark + t.replace("\n", "\n" + mark) for t, _, _ in WRAPPED for mark in ("", "# ", " * ")] + ["This file is licensed under the MIT License; see LICENSE for\nall of it. All rights reserved.", "This is not what is released under the GPL v2.", "İK no W words\r\n\r\nAll rights reserved", None, ""]
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    rel = con.sql(licenses.oracle())
    df = licenses.scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(map(str, rel.fetchall())) == sorted(str(tuple(r[c] for c in rel.columns)) for r in df.collect())


def test_every_known_sentence_is_found(spark):
    texts = [f"Some line that is long enough to be a full one\n{s}.\nmore" for s in licenses.KNOWN]
    assert [r[2] for r in found(spark, *texts)] == list(licenses.KNOWN.values())
