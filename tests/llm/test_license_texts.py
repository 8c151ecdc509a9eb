"""License texts and short notices that op1_license_windows must find."""

from __future__ import annotations

from furlens.llm import licenses


def found(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {(r.doc_id, r.license): r for r in licenses.scanned(frame).collect()}


def test_short_notices(spark):
    got = found(spark, ["All rights reserved.", "x y. ALL  RIGHTS-reserved, all rights reserved", "all rights are reserved", "Distributed under the MIT License", None, ""])
    assert set(got) == {(0, "All-rights-reserved"), (1, "All-rights-reserved"), (3, "MIT-distributed")}
    assert got[1, "All-rights-reserved"].n_windows == 2 and got[1, "All-rights-reserved"].first_word == 2


def test_whole_texts(spark):
    names = sorted(licenses.TEXTS)
    assert {"Apache-2.0-text", "GPL-3.0-text", "LGPL-2.1-text", "MPL-2.0-text", "BSD-3-Clause-text", "MIT-text", "ISC-text"} <= set(names)
    got = found(spark, ["Some words before. " * 9 + licenses.TEXTS[name] + " tail" for name in names])
    assert all(got[i, name].containment == 1 for i, name in enumerate(names))


def test_body_without_its_notice_sentence(spark):
    body = licenses.TEXTS["MIT-text"]
    got = found(spark, [body[body.index("Software without restriction") :]])
    assert set(got) == {(0, "MIT-text")}
