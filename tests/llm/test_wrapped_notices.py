import textwrap

from rrnlake.llm import licenses
from tests.llm.helpers import docs


def test_notices_wrapped_over_lines_are_found(spark):
    bodies = dict(licenses.TEMPLATES)
    labels = ["mit-grant", "bsd-3-clause", "mpl-2.0"]
    rows = [(i, textwrap.fill("Some words before. " + bodies[name], 72, initial_indent="# ", subsequent_indent="# "))
            for i, name in enumerate(labels)]
    rows.append((7, "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0."))
    apart = bodies["mit-grant"].split()
    rows.append((8, "\n".join(" ".join(apart[k : k + 6]) + " filler" * 30 for k in range(0, len(apart), 6))))
    rows.append((9, "All the words\nhere are plain " + "and more " * 20 + "\nrights stand far off, as does reserved"))
    got = {r.doc_id: set(r.labels.split(",")) for r in licenses.scan_documents(docs(spark, rows)).collect()}
    for i, name in enumerate(labels):
        assert name in got[i]
    assert "mpl-2.0" in got[7] and "mit-grant" not in got[8] and "all-rights-reserved" not in got[9]


def test_lines_are_cut_once_for_both_scans(spark, monkeypatch):
    """Words of whole texts come from those of their lines; a phrase whose words stand apart gives no label."""
    cut = []
    own = licenses.template_blocks
    monkeypatch.setattr(licenses, "template_blocks", lambda *a: cut.append(1) or own(*a))
    notice = "This work is licensed under the\nGNU General Public\nLicense, "
    rows = [(1, notice + "version 3."), (2, notice + "3rd\nversion or\n3."), (3, "Plain words.\nAnd more."), (4, None), (4, ""), (5, notice + "version 2.")]
    got = {r.doc_id: set(filter(None, r.labels.split(","))) for r in licenses.scan_documents(docs(spark, rows)).collect()}
    assert got == {1: {"gpl", "gpl-3.0"}, 2: {"gpl"}, 3: set(), 4: set(), 5: {"gpl", "gpl-2.0"}}
    assert len(cut) == 1
    alone = {(r.doc_id, r.label) for r in licenses.wrapped_notices(docs(spark, rows)).collect()}
    assert alone == {(1, "gpl-3.0"), (5, "gpl-2.0")}
