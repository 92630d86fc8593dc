"""License notices of the usual families, told apart from their siblings."""

from lakemart.llm import licenses


def test_license_families_are_told_apart(spark):
    t = licenses.TEMPLATES
    pad = " some words before here and there "
    cases = [("This work is licensed under the GNU General Public License, version 2", "GPL-2.0"),
             ("This work is licensed under the GNU General Public License, version 3", "GPL-3.0"),
             ("This work is licensed under the GNU Lesser General Public License, version 3", "LGPL-3.0"),
             ("This work is licensed under the GNU Lesser General Public License, version 2.1", "LGPL-2.1"),
             ("GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007", "AGPL-3.0"),
             ("GNU GENERAL PUBLIC LICENSE\n Version 2, June 1991", "GPL-2.0"), ("Eclipse Public License - v 2.0", "EPL-2.0"),
             ("CC0 1.0 Universal", "CC0-1.0"), (t["Unlicense"], "Unlicense"), (t["BSD-2-Clause-text"], "BSD-2-Clause-text"),
             (t["BSD-3-Clause-text"], "BSD-3-Clause-text"), ("Released under the MIT License", "MIT"), ("no notice at all", ""),
             (t["BSD-3-Clause-text"] + pad * 60 + t["BSD-2-Clause-text"], "BSD-2-Clause-text,BSD-3-Clause-text"),
             *[(t[n], n) for n in t if n.endswith("header") and n.split("-")[0] in ("GPL", "LGPL", "AGPL")]]
    docs = spark.createDataFrame([(i, pad + c + "." + pad) for i, (c, _) in enumerate(cases)], "doc_id bigint, text string")
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(docs).collect()}
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]
