import re
import textwrap

import numpy as np

from rrnlake.llm import licenses
from tests.llm.helpers import docs


def labels(spark, rows):
    return {r.doc_id: set(filter(None, r.labels.split(","))) for r in licenses.scan_documents(docs(spark, rows)).collect()}


def test_one_version_of_a_family(spark):
    got = labels(spark, [
        (1, "This work is licensed under the GNU General Public License, version 3."),
        (2, "This work is licensed under the GNU General Public License, version 2."),
        (3, "This work is licensed under the GNU General Public License, any version."),
        (4, "Licensed under CC BY-NC 4.0."), (5, "Licensed under CC BY-SA 4.0."), (6, "Licensed under CC BY 4.0."),
        (7, "Released under the Apache License."), (8, "Released under the MIT License."),
        (9, "Licensed under CC BY 4.0.\nText between.\nLicensed under CC BY-NC 4.0."),
        (10, "This work is licensed under the\nGNU General Public\nLicense, version 3."),
        (11, "Licensed under CC\nBY-NC\n4.0."),
        (12, "Licensed under the Apache License, Version 2.0. Licensed under CC BY 4.0."),
    ])
    assert got == {
        1: {"gpl", "gpl-3.0"}, 2: {"gpl", "gpl-2.0"}, 3: {"gpl"}, 4: {"cc-by", "cc-by-nc-4.0"}, 5: {"cc-by", "cc-by-sa-4.0"},
        6: {"cc-by", "cc-by-4.0"}, 7: {"apache"}, 8: {"mit", "mit-notice"}, 9: {"cc-by", "cc-by-4.0", "cc-by-nc-4.0"},
        10: {"gpl", "gpl-3.0"}, 11: {"cc-by", "cc-by-nc-4.0"}, 12: {"apache", "apache-2.0", "cc-by", "cc-by-4.0"}}


def test_labels_equal_all_pairs(spark):
    """Lines and word windows against every template, in plain Python."""
    made, rules = np.random.default_rng(3), licenses.LicenseRules()
    phrases = dict(rules.telling)
    bodies = [b for _, b in rules.templates]
    filler = ["some", "other", "words", "the", "and", "version", "license", "of", "3", "by"]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(int(made.integers(1, 4))):
            words = str(made.choice(bodies)).split()
            parts.append(" ".join(w for w in words if made.random() > 0.06))
            parts.append(" ".join(made.choice(filler, int(made.integers(0, 12)))))
        rows.append((i, textwrap.fill(" ".join(parts), int(made.integers(20, 200)))))

    def split(text):
        return [w for w in re.split(licenses.BREAK, text.lower()) if w]

    def holds(words, label, wanted):
        told = label not in phrases or f" {phrases[label]} " in f" {' '.join(words)} "
        return told and len(wanted & set(words)) >= rules.containment * len(wanted) - 1e-9

    want = {}
    for i, text in rows:
        words = split(text)
        want[i] = {label for phrase, label in rules.phrases if f" {phrase} " in f" {' '.join(words)} "}
        for label, body in rules.templates:
            wanted, size = set(split(body)), int(np.ceil(len(split(body)) * 1.25))
            blocks = [split(line) for line in text.split("\n")]
            blocks += [words[k : k + size] for k in range(len(words))] if "\n" in text else []
            if any(holds(b, label, wanted) for b in blocks):
                want[i].add(label)
    assert labels(spark, rows) == want
    assert len(set().union(*want.values())) > 10
