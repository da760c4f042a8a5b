import random
import re
from collections import defaultdict

import pytest
from conftest import AWKWARD

from sitelens.llm import line_templates


def run(spark, frame, rows, **options):
    return {r["doc_id"]: r for r in line_templates.drop_recurring_lines(frame(rows), **options).collect()}


def body(i):
    return f"Unique opening {'abcdefghij'[i % 10] * (i + 1)} of text\nand {'klmnopqrst'[i % 10] * (i + 2)} more words that differ here"


def test_variable_fields_are_generalised(spark, frame):
    rows = [(i, f"{body(i)}\nPage {i} of {100 + i} printed on request") for i in range(8)]
    got = run(spark, frame, rows)
    assert all(got[i]["text"] == body(i) and got[i]["n_dropped"] == 1 and got[i]["n_lines"] == 3 for i in range(8)) is False  # 4 of 6 constant
    rows = [(i, f"{body(i)}\nPage {i} of the report that was printed on request") for i in range(8)]
    got = run(spark, frame, rows)
    assert all(got[i]["text"] == body(i) and got[i]["n_dropped"] == 1 and got[i]["n_lines"] == 3 for i in range(8))


def test_rare_and_short_lines_stay(spark, frame):
    rows = [(i, f"{body(i)}\nAll rights reserved here" if i < 4 else f"{body(i)}\nSo be.") for i in range(20)]
    got = run(spark, frame, rows)
    assert all(got[i]["text"] == t and got[i]["n_dropped"] == 0 for i, t in rows)


def test_copies_of_one_text_make_nothing_recur(spark, frame):
    rows = [(i, "The very same line of words\nand another line of words") for i in range(50)]
    assert all(r["n_dropped"] == 0 for r in run(spark, frame, rows).values())


def test_near_copies_stay_whole(spark, frame):
    shared = "\n".join(f"common sentence number {w} in all copies" for w in "abcdefgh")
    rows = [(i, f"{shared}\n{body(i)}") for i in range(9)] + [(9, f"{body(9)}\n{body(19)}\ncommon sentence number a in all copies")]
    got = run(spark, frame, rows)
    assert all(got[i]["n_dropped"] == 0 for i in range(9)) and got[9]["n_dropped"] == 1


def test_awkward_rows(spark, frame):
    rows = line_templates.drop_recurring_lines(frame(AWKWARD)).collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in rows) == sorted(str(x) for x in AWKWARD)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["n_lines"] == 0 and by_id[2]["n_lines"] == 1 and by_id[10]["n_lines"] == 4 and by_id[10]["line"] == "own"


def test_empty_table(spark, frame):
    assert line_templates.drop_recurring_lines(frame([])).count() == 0


def drop_all(spark, frame, rows):
    return {r["doc_id"]: r for r in line_templates.drop_all_recurring_lines(frame(rows)).collect()}


def test_recurring_lines_go_from_short_documents_too(spark, frame):
    passage = " ".join(f"boiler{'abcdefghijklmnopqrstuvwxyz'[i % 26]}{'xyz'[i // 26]}" for i in range(55))
    own = lambda i, n: " ".join(f"own{'abcdefghij'[i]}{'klmnopqrst'[w % 10] * (w // 10 + 1)}" for w in range(n))
    rows = [(i, f"{own(i, 40 if i < 6 else 200)}\n{passage}") for i in range(9)]
    got = drop_all(spark, frame, rows)
    assert got[0]["text"] == rows[0][1] and got[0]["n_dropped"] == 0  # the carrier
    assert all(got[i]["text"] == rows[i][1].split("\n")[0] and got[i]["n_dropped"] == 1 for i in range(1, 9))


def test_one_near_copy_stays_whole(spark, frame):
    shared = "\n".join(f"common sentence number {w} in all copies" for w in "abcdefgh")
    rows = [(i, f"{shared}\n{body(i)}") for i in range(9)]
    got = drop_all(spark, frame, rows)
    assert got[0]["text"] == rows[0][1] and all(got[i]["text"] == body(i) for i in range(1, 9))


@pytest.mark.parametrize("line", ["So be.", "全著作権所有", "Copyright 2024 Example Inc", "Call us 24/7: 555 0123", "2024"])
def test_verbatim_lines_go_whatever_their_tokens(spark, frame, line):
    rows = [(i, f"{body(i)}\n{line}") for i in range(8)]
    got = drop_all(spark, frame, rows)
    assert got[0]["text"] == rows[0][1] and all(got[i]["text"] == body(i) for i in range(1, 8))
    rare = drop_all(spark, frame, [(i, f"{body(i)}\n{line}" if i < 4 else body(i)) for i in range(8)])
    assert all(r["n_dropped"] == 0 for r in rare.values())


def test_half_of_a_template_may_be_fields(spark, frame):
    for line in ("Page {} of {} printed on request", "Page {} of {}"):
        rows = [(i, body(i) + "\n" + line.format(i, 100 + i)) for i in range(8)]
        got = drop_all(spark, frame, rows)
        assert got[0]["text"] == rows[0][1] and all(got[i]["text"] == body(i) for i in range(1, 8))


def test_same_digits_are_constant(spark, frame):
    rows = [(i, f"{body(i)}\nCopyright 2024 Example Inc page {'abcdefgh'[i]}") for i in range(8)]  # 5 of 6 with the year, 4 without
    assert all(r["text"] == body(i) for i, r in run(spark, frame, rows).items())


def brute(rows, least=5):
    """The method on lists: the kept text and the number of dropped lines of each row."""
    lines = lambda text: [x.strip(" ") for x in text.split("\n")]
    leaf = lambda line: (line.count(" "), re.sub(r"\S*[0-9]\S*", "<*>", " ".join(line.split(" ")[:3])))
    held = defaultdict(set)  # the texts of each line
    for _, text in rows:
        for line in lines(text) if text is not None else ():
            held[line].add(text)
    held.pop("", None)
    seen = defaultdict(int)
    for line, texts in held.items():
        for at, token in enumerate(line.split(" ")):
            seen[leaf(line), at, token] += len(texts)
    template, shared = {}, defaultdict(set)
    for line, texts in held.items():
        tokens = line.split(" ")
        shown = [t if seen[leaf(line), at, t] >= least else None for at, t in enumerate(tokens)]
        constant = sum(t is not None for t in shown)
        if constant >= 2 and 2 * constant >= len(tokens):
            template[line] = (leaf(line), *shown)
            shared[template[line]] |= texts
    template = {x: t for x, t in template.items() if len(shared[t]) >= least}
    template |= {x: (x,) for x, texts in held.items() if len(texts) >= least and x not in template}
    carrier = {}
    for doc_id, text in rows:
        for line in lines(text) if text is not None else ():
            if line in template:
                t = template[line]
                carrier[t] = min(carrier.get(t, (True, 0)), (doc_id is None, doc_id or 0))
    out = []
    for doc_id, text in rows:
        goes = [x in template and carrier[template[x]] != (doc_id is None, doc_id or 0) for x in lines(text)] if text is not None else []
        kept = None if text is None else "\n".join(x for x, gone in zip(text.split("\n"), goes) if not gone)
        out.append((str(doc_id), str(kept), len(goes), sum(goes)))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_all_recurring_lines_equal_brute_force(spark, frame, seed):
    rng = random.Random(seed)
    words = [a + b for a in "abcdefgh" for b in "stuvwxyz"]
    forms = ["Page {} of {} printed", "Posted by {} on day {}", "{} {} all rights reserved", "Copyright 2024 {}", "So be.", "view {} {} {}", " trim me {} "]

    def line():
        if rng.random() < 0.5:
            return " ".join(rng.choices(words, k=rng.randint(1, 6)))
        return rng.choice(forms).format(*(rng.choice([rng.choice(words), str(rng.randint(0, 12))]) for _ in range(3)))

    rows = [(i, "\n".join(line() for _ in range(rng.randint(0, 8)))) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(8)] + [(None, rows[3][1] + "\nSo be."), (200, None), (201, ""), (202, "\n\n")]
    got = line_templates.drop_all_recurring_lines(frame(rows)).collect()
    assert sorted((str(r["doc_id"]), str(r["text"]), r["n_lines"], r["n_dropped"]) for r in got) == brute(rows)


def test_all_lines_of_awkward_rows_and_an_empty_table(spark, frame):
    got = line_templates.drop_all_recurring_lines(frame(AWKWARD)).collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in got) == sorted(str(x) for x in AWKWARD)
    assert line_templates.drop_all_recurring_lines(frame([])).count() == 0


def test_a_very_long_line_recurs_too(spark, frame):
    long = "token " * 50_000 + "end"
    got = drop_all(spark, frame, [(i, f"{body(i)}\n{long}") for i in range(6)])
    assert got[0]["n_dropped"] == 0 and all(got[i]["text"] == body(i) for i in range(1, 6))
