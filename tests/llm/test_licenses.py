import random
import re

import pytest
from conftest import AWKWARD

from sitelens.llm import license_scan
from sitelens.llm.license_templates import PHRASES, TEMPLATES


def pattern(markup):
    """The template as a regular expression over words that are each followed by a blank."""
    out, at = "", 0
    plain = lambda t: "".join(re.escape(w) + " " for w in license_scan.words_of(t))
    for m in re.finditer(r"\[\[(.*?)\]\]|<<(\d+)>>", markup, re.DOTALL):
        out += plain(markup[at:m.start()])
        out += rf"(?:[^ ]+ ){{0,{m[2]}}}?" if m[2] else f"(?:{plain(m[1])})??"
        at = m.end()
    return re.compile(out + plain(markup[at:]))


def brute(text, templates):
    """Shortest accepted stretch of every template at every word, by regular expressions."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    line, starts, at = "".join(w + " " for w in words), [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends, found = {s: i for i, s in enumerate([*starts, at])}, []
    for i, start in enumerate(starts):
        for label, markup, phrase in templates:
            stops = [e for e in range(start + 1, len(line) + 1) if e in ends and pattern(markup).fullmatch(line, start, e)] if (
                pattern(markup).match(line, start)) else []
            if stops:
                found.append((label, phrase, i, ends[stops[0]]))
    return len(words), sorted(found)


SMALL = [("one", "alpha beta", True), ("two", "alpha [[beta]] gamma", False), ("three", "beta <<3>> alpha", False),
         ("four", "gamma [[alpha beta]] <<2>> [[beta]] gamma", False), ("five", "alpha <<1>> [[beta gamma]] delta", False)]


def test_automata_equal_regular_expressions():
    automata = [license_scan.compile_template(*t) for t in SMALL]
    scanner, rng, seen = license_scan.Scanner(automata), random.Random(2), 0
    for _ in range(600):
        text = " ".join(rng.choices(["alpha", "beta", "gamma", "delta", "Other", "BETA"], k=rng.randint(0, 14)))
        found = [(automata[i].label, automata[i].phrase, s, e) for i, s, e in scanner.matches(scanner.numbered(text.encode()))]
        n, want = brute(text, SMALL)
        assert sorted(found) == want, text
        seen += len(want)
    assert seen > 500


@pytest.mark.parametrize("label,markup", TEMPLATES)
def test_every_template_takes_its_own_wording_and_no_other(label, markup):
    scanner = license_scan.Scanner([license_scan.compile_template(label, markup)])
    full = re.sub(r"\[\[|\]\]", "", re.sub(r"<<\d+>>", "Some One", markup)) if "<<1>>" not in markup else re.sub(r"\[\[|\]\]", "", markup.replace("<<1>>", "4"))
    short = re.sub(r"<<\d+>>", "", re.sub(r"\[\[.*?\]\]", "", markup, flags=re.DOTALL))
    for text in (full, short):
        assert len(scanner.matches(scanner.numbered(f"So: {text}, it says".encode()))) >= 1
    words = license_scan.words_of(short)
    for i in range(len(words)):
        changed = " ".join([*words[:i], "otherwise", *words[i + 1:]])
        want = any(s == 0 for _, _, s, _ in brute(changed, [(label, markup, False)])[1])
        assert any(s == 0 for _, s, _ in scanner.matches(scanner.numbered(changed.encode()))) == want


def test_frames(spark, frame):
    rows = [*AWKWARD, (20, "Released under the MIT License."), (21, "x Licensed under CC BY-NC 4.0. Under the mit-license, UNDER THE MIT LICENSE"),
            (22, "Licensed under the Apache License, Version 2.0. " * 3), (23, "Éunder the MIT License"), (24, "under the MIT Licenseé"),
            (25, "GNU General Public License, version 3"), (26, "gnu general public license version 4"), (21, "cc by nc")]
    templates = [(label, phrase, True) for phrase, label in PHRASES.items()] + [(label, t, False) for label, t in TEMPLATES]
    got = sorted(((r["doc_id"], r["n_words"], sorted(tuple(m) for m in r["matches"]), r["covered"]) for r in license_scan.scan(frame(rows)).collect()), key=str)
    want = []
    for i, t in rows:
        n, found = brute(t, templates) if t is None or len(t) < 5000 else (len(t.split()), [])
        want.append((i, n, found, len({x for *_, s, e in found for x in range(s, e)})))
    assert got == sorted(want, key=str)
    assert {r[0]: len(r[2]) for r in got}[23] == 0


def test_a_long_text_of_leading_words(spark, frame):
    row = license_scan.scan(frame([(1, "GNU General Public License, " * 40_000 + "version 3")])).first()
    assert [(m["label"], m["start"], m["end"]) for m in row["matches"]] == [("gpl-3", 159_996, 160_002)]


def test_empty_table_and_empty_rules(spark, frame):
    assert license_scan.scan(frame([])).count() == 0
    row = license_scan.scan(frame([(1, "under the mit license")]), automata=[]).first()
    assert row["n_words"] == 4 and row["matches"] == [] and row["covered"] == 0


@pytest.mark.parametrize("markup", ["", "[[a]] b", "a <<3>>", "<<2>> a"])
def test_templates_need_wording_at_both_ends(markup):
    with pytest.raises(ValueError):
        license_scan.compile_template("x", markup)
