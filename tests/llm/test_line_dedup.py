from clickflow.llm import line_dedup as L
from clickflow.llm.common import documents
from tests.llm import brute
from tests.llm.conftest import SF01


def check(df, rows):
    want, texts = brute.first_lines(rows), dict(rows)
    for r in df.collect():
        spans = [tuple(map(int, x.split(":"))) for x in r.removed.split(",") if x]
        text = texts[r.doc_id] or ""
        assert spans == want[r.doc_id]
        assert (r.n_removed, r.removed_chars) == (len(spans), sum(b - a for a, b in spans))
        left = "".join(c for i, c in enumerate(text) if not any(a <= i < b for a, b in spans))
        assert "".join(r.kept_text.split()) == "".join(left.split())


def test_matches_brute_force(spark, frame, odd_rows):
    got = L.line_dedup(frame(odd_rows))
    assert got.count() == len(odd_rows)
    check(got, odd_rows)
    docs = documents(spark, SF01)
    check(L.line_dedup(docs), [(r.doc_id, r.text) for r in docs.collect()])


def test_short_lines_are_units(frame):
    rows = [(1, "a\n\nb\n \nb"), (2, "B\nc\n-\n"), (3, "-\nc \n\tb\nd")]
    got = {r.doc_id: r for r in L.line_dedup(frame(rows)).collect()}
    check(L.line_dedup(frame(rows)), rows)
    assert [(got[i].n_units, got[i].n_removed, got[i].kept_text) for i in (1, 2, 3)] == [
        (3, 1, "a\n\nb\n \n"),
        (3, 1, "c\n-\n"),
        (4, 3, "d"),
    ]


def test_passages_inside_longer_lines(frame):
    """A copied passage between other sentences: its sentences go, what surrounds them stays as it was."""
    one = "The first sentence of the passage has more than fifty characters in it."
    two = "The second one is as long as that, and it is also part of the passage!"
    rows = [
        (1, f"{one} {two}"),
        (2, f"Something else before. {one}  {two.upper()} And after."),
        (3, f"Short. {one}\nShort. Other."),
        (4, f"{two}\n{one} {two}"),
        (5, f"{one} {one} New here."),
    ]
    got = {r.doc_id: r for r in L.line_dedup(frame(rows)).collect()}
    check(L.line_dedup(frame(rows)), rows)
    assert {i: r.n_removed for i, r in got.items()} == {1: 0, 2: 2, 3: 1, 4: 2, 5: 2}
    assert got[2].kept_text == "Something else before. And after."
    assert got[3].kept_text == "Short. \nShort. Other."
    assert got[4].kept_text == "" and got[5].kept_text == "New here."
    whole = L.line_dedup(frame(rows), least_sentence=None).collect()
    assert {r.doc_id: r.n_removed for r in whole} == {1: 0, 2: 0, 3: 0, 4: 1, 5: 0}


def test_paragraphs(frame):
    a, b = "first paragraph of the text\nwith two lines", "second paragraph, alone here"
    rows = [(1, a + "\n\n" + b), (2, b + "\n \n" + a + "\n\nnew paragraph is kept")]
    got = {r.doc_id: r for r in L.line_dedup(frame(rows), unit="paragraph").collect()}
    assert got[1].n_removed == 0 and got[2].n_removed == 2
    assert got[2].kept_text.strip() == "new paragraph is kept"


def test_null_ids_repeated_rows_and_empty_tables(frame, no_id_rows):
    got = L.line_dedup(frame(no_id_rows)).collect()
    assert len(got) == len(no_id_rows)
    # doc 5 ranks first; its two equal rows keep the line, as the third keeps its own; the rows without an id lose it
    assert [r.n_removed for r in got if r.n_units and r.doc_id == 5] == [0, 0, 0]
    assert sum(r.n_removed for r in got if r.doc_id is None) == 2
    assert L.line_dedup(frame([])).collect() == []
