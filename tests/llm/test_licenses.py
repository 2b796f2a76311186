import duckdb
import pytest
from compare import connect, differences

from basketmart.llm.licenses import op1_license_sentences, oracle, scan_licenses


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert differences(op1_license_sentences(spark, folder), connect(folder), oracle()) == []


MIT = (
    "/* Copyright (c) 2020 Someone. All rights reserved.\n * Permission is hereby granted, free of charge, to any person "
    "obtaining a copy of it.\n * The above copyright notice and this permission notice shall be included.\n"
    ' * THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND. */'
)


@pytest.mark.parametrize(
    "text, sentences, licenses",
    [
        (None, "", ""),
        ("", "", ""),
        ("Nothing of the kind. Not here!", "", ""),
        ("x\nReleased under the MIT License.\ny", "mit", "MIT"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl3", "GPL-3.0"),
        ("Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0.", "ccByNc apache2", "Apache-2.0 CC-BY-NC"),
        (MIT, "copyright reserved mitGrant mitNotice asIs", "MIT"),
        ("A licence of its own kind.", "unknown", "unknown"),
        ("Copyright 2020 X", "copyright", ""),
        ("Redistributions of source code must retain it.\nRedistribution and use in source and binary forms, with or without modification, are permitted.", "bsdSource bsdGrant", "unknown"),
        ("# SPDX-License-Identifier: MIT", "spdxMit", "MIT"),
        ("Released under the MIT License.\n" * 3, "mit mit mit", "MIT"),
        ("word " * 60_000 + "\nReleased under the MIT License.", "mit", "MIT"),
    ],
)
def test_sentences_and_rules(spark, text, sentences, licenses):
    docs = spark.createDataFrame([(1, text, "x"), (1, text, "x")], "doc_id long, text string, licenses string")
    rows = scan_licenses(docs).collect()
    assert [(r.sentences, r.licenses, r.n_unknown) for r in rows] == 2 * [(sentences, licenses, sentences.count("unknown"))]


def test_rules_take_part_in_order(spark):
    text = "Redistribution and use in source and binary forms, with or without modification, are permitted.\nRedistributions of source code must retain it.\nRedistributions in binary form must reproduce it.\n"
    names = "Neither the name of X nor others grants a permission.\n"
    docs = spark.createDataFrame([(1, text), (2, text + names), (None, names)], "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in scan_licenses(docs).collect()}
    assert got == {1: "BSD-2-Clause", 2: "BSD-3-Clause", None: "unknown"}


def test_empty_table(spark):
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


FREE = "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU {name}General Public License as published by\nthe Free Software Foundation; either version {version} of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU {name}General Public License for more details.\n\nYou should have received a copy of the GNU {name}General Public License\nalong with this program.\n"
NO_LIABILITY = "IN NO EVENT SHALL THE\nAUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER\nLIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE.\n"
WRAPPED_MIT = "MIT License\n\nCopyright (c) 2020 Someone\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. " + NO_LIABILITY
BSD2 = "Copyright (c) 2020, Someone\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n\n{names}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\"\nAND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE\nIMPLIED WARRANTIES OF MERCHANTABILITY ARE DISCLAIMED. " + NO_LIABILITY
NAMES = "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n\n"
ISC = "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES\nWITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF\nMERCHANTABILITY AND FITNESS. " + NO_LIABILITY
APACHE = "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License for the specific language governing permissions and\nlimitations under the License.\n"
NOTICES = [
    ("MIT", WRAPPED_MIT),
    ("BSD-2-Clause", BSD2.format(names="")),
    ("BSD-3-Clause", BSD2.format(names=NAMES)),
    ("ISC", ISC),
    ("Apache-2.0", APACHE),
    ("GPL-2.0", FREE.format(name="", version=2)),
    ("GPL-3.0", FREE.format(name="", version=3).replace("software;", "software:")),
    ("LGPL-2.1", FREE.format(name="Lesser ", version=2.1)),
    ("LGPL-3.0", FREE.format(name="Lesser ", version=3)),
    ("AGPL-3.0", FREE.format(name="Affero ", version=3)),
    ("GPL-2.0", FREE.format(name="", version=2).replace("\n\n", "\0").replace("\n", " ").replace("\0", "\n")),
    ("LGPL-2.1", "Distributed under the GNU Lesser General Public License version 2.1."),
    ("Apache-2.0", "Licensed to the Apache Software Foundation under the Apache License, Version 2.0."),
    ("Apache-2.0 MIT", "SPDX-License-Identifier: MIT OR Apache-2.0"),
    ("BSD-2-Clause", "// SPDX-License-Identifier: (BSD-2-Clause)"),
]


@pytest.mark.parametrize("leader", ["", " * ", "# ", "// "])
def test_notices_as_they_are_wrapped(spark, tmp_path, leader):
    texts = ["".join(leader + line for line in text.splitlines(keepends=True)) for _, text in NOTICES]
    texts = [f"/*\n{text}\n */\n" if leader == " * " else text for text in texts]
    texts.append("Something comes before it.\n\n" + texts[0] + "\nA licence of its own kind. " * 5 + "\n" + texts[3])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in scan_licenses(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [name for name, _ in NOTICES] + ["MIT ISC"]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert differences(op1_license_sentences(spark, str(tmp_path)), con, oracle()) == []


@pytest.mark.parametrize("unknown, licenses", [(3, "MIT"), (4, "unknown")])
def test_unknown_sentences_inside(spark, unknown, licenses):
    grant, *rest = MIT.split("\n * The above")
    text = grant + "\nA licence of its own kind." * unknown + "\n * The above" + rest[0]
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert scan_licenses(docs).first().licenses == licenses
