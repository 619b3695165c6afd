"""Licence sentences and rules."""

import duckdb
import pytest

from lodeworks.llm.licences import SENTENCES, TRIGGER, scan_licences
from lodeworks.llm.queries import _op1_sql, op1_license_scan

MIT = """/*
 * Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
 * documentation files (the "Software"), to deal in the Software without restriction, including without limitation
 * the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
 * permit persons to whom the Software is furnished to do so, subject to the following conditions:
 *
 * The above copyright notice and this permission notice shall be included in all copies or substantial portions of
 * the Software.
 *
 * THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
 * THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
 */"""
APACHE = """# Copyright 2020 Somebody
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""
GPL3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of"""
LGPL2 = """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version."""
GPL2 = "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."
BSD = """Copyright (c) 2020, Somebody. All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
   in the documentation and/or other materials provided with the distribution.
"""
HEADERS = [
    (APACHE, "Apache-2.0"),
    (MPL, "MPL-2.0"),
    ("Licensed under the Mozilla Public License, v. 2.0\nwords that go on", "MPL-2.0"),
    (GPL3, "GPL-3.0-or-later"),
    (LGPL2, "LGPL-2.1-or-later"),
    (GPL2, "GPL-2.0-only"),
    (BSD, "BSD-2-Clause"),
    ("prose\nAll rights reserved.\nmore", "All-Rights-Reserved"),
    ("some prose\nAll rights\nreserved.", "All-Rights-Reserved"),
    ("This was released into the public\ndomain.", "Public-Domain"),
    ("// SPDX-License-Identifier: MIT\n// words that go on", "MIT"),
    ("/* SPDX-License-Identifier: Apache-2.0 */", "Apache-2.0"),
]
CASES = [
    ("some prose\nLicensed under the Apache Licence, Version 2.0.\nmore", "Apache-2.0"),
    ("Released under the MIT License. And more.", "MIT"),
    ("This work is licensed under the GNU General Public License, v3.0.", "GPL-3.0"),
    ("Licensed under CC BY-NC 4.0.\n\nLicensed under CC BY-NC 4.0. Released under the MIT License.", "CC-BY-NC-4.0 MIT"),
    (MIT, "MIT"),
    ("This is a license to talk about copyright and permission.", ""),
    ("", ""),
    (None, ""),
]


@pytest.mark.parametrize(("text", "expected"), CASES)
def test_cases(spark, text, expected):
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert [" ".join(r.licences) for r in scan_licences(docs).collect()] == [expected] * 2


@pytest.mark.parametrize(("text", "expected"), HEADERS)
def test_canonical_headers(spark, text, expected):
    (row,) = scan_licences(spark.createDataFrame([(text,)], "text string")).collect()
    assert (row.licences, row.unmatched) == ([expected], [])


BSD3 = BSD.replace("Copyright (c) 2020, Somebody. All", "All") + """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
   from this software without specific prior written permission.
"""
FORMS = [
    (BSD3, "BSD-3-Clause", "rights-reserved bsd-grant bsd-source bsd-binary bsd-endorse"),
    (
        "Released under the MIT License\nLicensed under the Apache License, Version 2.0\nyou may not use this file except in compliance with the License.",
        "MIT Apache-2.0",
        "mit-short apache-2.0-short apache-use",
    ),
    ("License: MIT", "MIT", "named-mit"),
    ("License: Apache License 2.0.\nAuthor: X", "Apache-2.0", "named-apache-2.0"),
    ("Distributed under the MIT License.", "MIT", "mit-short"),
    ("Licensed under the Apache License 2.0.", "Apache-2.0", "apache-2.0-short"),
    ("Licensed under the MIT license (see LICENSE).", "MIT", "mit-short"),
    ("The code is also available under the 3-Clause BSD licence.", "BSD-3-Clause", "bsd-3-short"),
    ("// SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause", "spdx-bsd-2-clause"),
    ("# SPDX-License-Identifier: MIT OR Apache-2.0\n", "MIT Apache-2.0", "spdx-mit spdx-apache-2.0"),
    ("# SPDX-License-Identifier: (ISC AND MIT) OR MPL-2.0\nx", "ISC MIT MPL-2.0", "spdx-isc spdx-mit spdx-mpl-2.0"),
    ("Released under the MIT License. Released under the MIT License. Released under CC0.", "MIT CC0-1.0", "mit-short mit-short cc0-short"),
    ("Copyright 2020 A B and others, licensed under the MIT License", "MIT", "mit-short"),
    ("words\nthat run on\nThis work is\nlicensed under the\nMIT License", "MIT", "mit-short"),
    ("This is not released under the MIT License.", "", ""),
    ("This isn't released under the MIT License.", "", ""),
    ("It was never\nreleased under the MIT License.", "", ""),
    ("Nothing here is released under the MIT License.", "", ""),
    ("I wonder whether people ever released under the MIT License", "", ""),
    ("words " * 30_000 + "\n" * 2 + "Released under the MIT License.\n" + "more\n" * 20_000, "MIT", "mit-short"),
]


@pytest.mark.parametrize(("text", "licences", "ids"), FORMS)
def test_forms_and_order(spark, text, licences, ids):
    (row,) = scan_licences(spark.createDataFrame([(text,)], "text string")).collect()
    assert (" ".join(row.licences), row.sentence_ids) == (licences, ids)


def test_sql_gives_the_same_for_all_cases(spark, tmp_path):
    texts = [case[0] for case in [*CASES, *HEADERS, *FORMS]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        expected = sorted(db.sql(_op1_sql()).fetchall())
    assert sorted(map(tuple, op1_license_scan(spark, str(tmp_path)).collect())) == expected


def test_identifiers_that_no_rule_takes_are_reported(spark):
    docs = spark.createDataFrame([("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",)], "text string")
    (row,) = scan_licences(docs).collect()
    assert (row.licences, row.unmatched) == ([], ["bsd-source"])


def test_every_sentence_has_a_trigger_word():
    words = TRIGGER.split("|")
    assert [text for text, _ in SENTENCES if not any(w in text for w in words)] == []


def test_odd_rows(spark, odd_documents, no_documents):
    found = scan_licences(odd_documents.withColumnRenamed("h", "licences"))
    assert found.count() == odd_documents.count()
    assert found.where("size(licences) > 0 OR sentence_ids <> ''").isEmpty()
    assert scan_licences(no_documents).collect() == []


def test_plan_is_one_pass(documents):
    plan = scan_licences(documents)._jdf.queryExecution().toString()
    assert "Exchange" not in plan
