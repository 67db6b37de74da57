import pytest

from rosterlake.llm.licences import recognise


def scan(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.sentence_ids, r.licences, r.n_left) for r in recognise(rows).orderBy("doc_id").collect()]


#: Notices as they stand in files, wrapped and in comments, each with the licences a reader would name.
NOTICES = [
    ("""# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
""", "Apache-2.0"),
    ("""MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED.
""", "MIT"),
    ("""/*
 * Copyright (c) 1998, The People. All rights reserved.
 *
 * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions are met:
 *
 * 1. Redistributions of source code must retain the above copyright notice,
 *    this list of conditions and the following disclaimer.
 * 2. Redistributions in binary form must reproduce the above copyright notice,
 *    this list of conditions and the following disclaimer in the documentation.
 * 3. Neither the name of the copyright holder nor the names of its contributors
 *    may be used to endorse or promote products derived from this software
 *    without specific prior written permission.
 *
 * THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS".
 */""", "BSD-3-Clause"),
    ("""Redistribution and use in source and binary forms, with or without
modification, are permitted.""", "BSD"),
    ("""This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""", "GPL-3.0-or-later"),
    ("""// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this
// file, You can obtain one at https://mozilla.org/MPL/2.0/.""", "MPL-2.0"),
    ("Distributed under the GNU General Public License, version 2.0.", "GPL-2.0"),
    ("It is free under the\nGNU Lesser General Public License v2.1.", "LGPL-2.1"),
    ("The BSD 3-Clause License\nCopyright of the authors", "BSD-3-Clause"),
    ("# SPDX-License-Identifier: BSD-3-Clause\nimport os", "BSD-3-Clause"),
    ("License: Apache-2.0 OR MIT", "Apache-2.0,MIT"),
    ("/* SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR MIT */", "GPL-2.0"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.", "ISC"),
    ("Lizenz: CC BY-SA 4.0 International", "CC-BY-SA-4.0"),
    ("Copyright (c) 2020 Someone. All rights reserved.", "proprietary"),
    ("Ein Haus mit Garten und ein Text mit oder ohne Sinn.", ""),
    ("He was granted permission to speak. A license to drive, and no more copies.", ""),
]


@pytest.fixture(scope="module")
def notices(spark):
    return scan(spark, *(text for text, _ in NOTICES))


@pytest.mark.parametrize("i", range(len(NOTICES)))
def test_ordinary_notices(notices, i):
    assert notices[i][1] == NOTICES[i][1], notices[i]


def test_wrapping_does_not_matter(spark):
    """The same words, however they are broken into lines and whatever comment they stand in."""
    words = NOTICES[0][0].replace("#", "").split()
    wrapped = []
    for width, mark in ((5, "# "), (9, " * "), (200, ""), (13, "// ")):
        lines = [" ".join(words[i : i + width]) for i in range(0, len(words), width)]
        wrapped.append("\n".join(mark + line for line in lines))
    assert {x[1] for x in scan(spark, *wrapped, wrapped[0].replace("\n", "\r\n"))} == {"Apache-2.0"}


def test_sentences_and_rules(spark):
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files."
    notice = "The above copyright notice and this permission notice shall be included in all copies or substantial portions."
    got = scan(
        spark,
        "Words. Licensed under the Apache License, Version 2.0.\nMore words.",
        f"{grant} {notice} THIS SOFTWARE IS PROVIDED \"AS IS\", without warranty.",
        "This work is licensed under the GNU General Public License, version 3.\nReleased under the MIT License.",
        "Licensed under CC BY-NC 4.0.",
        "Copyright (c) 2020 Someone. All rights reserved.",
        "Copyright (c) 2020 Someone. And then some. All rights reserved.",
        "We talk of a license to drive. Nothing here is licensed.",
        "Released under the MIT License. Released under the MIT License.",
        None, "", "x " * 50_000 + "\nSPDX-License-Identifier: MIT",
        f"{grant} One. Two. Three. {notice} 1. 2. 3. 4. The software is provided as is.",
    )
    assert got == [
        ("apache-2.0", "Apache-2.0", 0), ("mit-grant,mit-notice,as-is", "MIT", 0), ("gpl-3,mit", "GPL-3.0,MIT", 0),
        ("cc-by-nc-4.0", "CC-BY-NC-4.0", 0), ("copyright,all-rights", "proprietary", 0), ("copyright,all-rights", "", 2),
        ("", "", 0), ("mit,mit", "MIT", 0), ("", "", 0), ("", "", 0), ("spdx-MIT", "MIT", 0),
        ("mit-grant,mit-notice,as-is", "MIT", 1),
    ]


def test_awkward_rows(spark, awkward, nothing):
    found = recognise(awkward)
    assert found.count() == awkward.count() and recognise(nothing).count() == 0
    assert set(found.columns) == set(awkward.columns) | {"n_left"}
    assert {r.licences for r in found.collect()} == {""}
