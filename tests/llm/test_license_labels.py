"""Labels of repeated notices, and of notices that have siblings."""

import pytest

from folioflow.llm import licenses


def labels(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = sorted(licenses.license_scan(docs).collect(), key=lambda r: r["doc_id"])
    return [r["labels"] for r in rows], [r["score"] for r in rows]


def test_repeated_notices(spark):
    texts, want = [], []
    for name, label in (("GNU Lesser General Public License", "lgpl"), ("GNU Affero General Public License", "agpl")):
        for between in ("", " pkg", " a b", " a b c", " a b c d e f g h i j"):
            for n in (1, 2, 4, 5, 6, 50):
                texts.append(" ".join([name + between] * n))
                want.append(label)
    found, scores = labels(spark, texts)
    assert found == want and set(scores) == {1.0}


def test_each_notice_has_its_own_label(spark):
    texts = [t for t, _ in licenses.BASE + licenses.NOTICES]
    assert labels(spark, texts)[0] == [label for _, label in licenses.BASE + licenses.NOTICES]


@pytest.mark.parametrize("text, label", [
    ("Licensed under the GNU General Public License version 3 and so on", "gpl-3"),
    ("Licensed under the GNU Lesser General Public License version 3", "lgpl"),
    ("This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", "cc-by-sa"),
    ("This work is licensed under a Creative Commons Attribution 3.0 Unported License", "cc-by"),
    ("This work is licensed under CC BY", ""),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007", "gpl-3"),
    ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991", "gpl-2"),
    ("This file is licensed under the GNU General Public License, either version 3 or later.", "gpl-3"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3"),
    ("# SPDX-License-Identifier: GPL-2.0-only", "gpl-2"),
    ("// SPDX-License-Identifier: MIT\nint main", "mit"),
    ("SPDX-License-Identifier: Apache-2.0\nSPDX-License-Identifier: BSD-3-Clause", "apache-2,bsd"),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl"),
    ("SPDX-License-Identifier: Something-Else-1.0", ""),
    ("Mozilla Public License Version 2.0", "mpl-2"),
    ("BSD 3-Clause License\n\nCopyright (c) 2020", "bsd"),
    ("the general public may read this license at 29 June 2007 in version 3", ""),
    ("Licensed under the GNU General Public License version 2. Licensed under the GNU General Public License version 3", "gpl-2,gpl-3"),
])
def test_siblings(spark, text, label):
    assert labels(spark, [text])[0] == [label]
