"""Masters with one header row load to the answers of their two-row sources."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from test_ingest import SUB, TOP, drift_tree, make_tree, write_csv, write_xlsx

from visitlens.functions.text import header_text
from visitlens.plans.build import build_masters
from visitlens.sources import ingest as I
from visitlens.sources.decoders import header_depth, is_typed, layout_of


def grid(*rows):
    return {r: {c: v or None for c, v in enumerate(row)} for r, row in enumerate(rows)}


@pytest.mark.parametrize("rows, depth", [
    ((TOP, SUB), 2), ((["Respondent ID", "Food"], ["", "Rating"]), 2), ((["Respondent ID", "Food"], ["", ""]), 2),
    ((["Respondent ID", "Food"], ["7", "Good"]), 1), ((["a", "", "b"], ["1", "2", "3"]), 2), ((["a", "a"], ["1", "2"]), 2),
    ((["client_id", "client_name", "venue_name", "Food Rating"], ["C001", "acme", "Bar", "Good"]), 1),
    ((["Client Name", "Venue Name", "Why"], ["", "", ""]), 1), ((["Day", "Why"], ["05/09/2024", "x"]), 1), ((["Day", "Why"], ["Date", "Open-Ended"]), 2),
    ((["Flag", "Why"], ["True", ""]), 1), ((["A", "B"],), 2), ((), 2)])
def test_header_depth(rows, depth):
    assert header_depth(grid(*rows)) == depth


def test_typed_values():
    assert all(map(is_typed, ["1", "-2.5", "1e5", " 7 ", "05/09/2024", "2024-09-05 07:30", "FALSE", "1,5"]))
    assert not any(map(is_typed, [None, "", "Response", "7pm", "1 to 5", "Q1", "12 days"]))


def test_layout_of_a_master():
    found = layout_of(grid(["client_id", "client_name", "venue_name", "Respondent ID", "Food Rating"], ["C001", "a", "v", "1", "Good"]))
    assert (found.depth, found.client, found.venue, found.respondent) == (1, 1, 2, 3)
    assert [header_text(*found.headers[c][:2]) for c in found.headers] == ["Respondent ID", "Food Rating"]


def answers(cells):
    good, bad = I.split_errors(cells)
    assert bad.count() == 0
    rows = I.answer_cells(good).where(F.col("value").isNotNull()).select("client_name", "venue_name", "row_id", "respondent_id", "header", "value")
    return sorted(map(tuple, rows.collect()))


def write_masters(found, kind):
    """One file a client, as earlier loads left them: flat headers, keys in the rows."""
    root = tempfile.mkdtemp(prefix="visitlens-flat-")
    for client in sorted({r[0] for r in found}):
        own = [r for r in found if r[0] == client]
        headers = list(dict.fromkeys(r[4] for r in own))
        lines = {}
        for _, venue, row, _, header, value in own:
            lines.setdefault((venue, row), {})[header] = value
        body = [["C001", client, venue, *[cells.get(h) for h in headers]] for (venue, _), cells in lines.items()]
        (write_xlsx if kind == "xlsx" else write_csv)(os.path.join(root, f"{client}_master.{kind}"), [["client_id", "client_name", "venue_name", *headers], *body])
    return root


@pytest.mark.parametrize("kind", ["csv", "xlsx"])
def test_flat_masters_give_the_answers_of_their_sources(spark, kind):
    source = drift_tree(spark)
    want = [r for r in answers(I.read_cells(spark, source)) if r[4] != "Venue Name"]
    root = write_masters(want, kind)
    back = answers(I.read_cells(spark, root, masters=True))
    assert sorted((c, v, who, h, x) for c, v, _, who, h, x in back) == sorted((c, v, who, h, x) for c, v, _, who, h, x in want)
    with open(os.path.join(root, "note.csv"), "w") as fh:  # not a master
        fh.write("a,b\n1,2\n")
    assert len(answers(I.read_cells(spark, root, masters=True))) == len(back)


def test_masters_build_from_either_layout(spark):
    source = make_tree()
    os.remove(os.path.join(source, "client_b", "broken.xlsx"))
    want = build_masters(spark, source, likert=[])
    root = write_masters(answers(I.read_cells(spark, source)), "csv")
    got = build_masters(spark, root, likert=[], masters=True)
    assert [r.client_name for r in got.clients.orderBy("client_name").collect()] == ["client_a", "client_b"]
    for name in ("client_a", "client_b"):
        one, two = got.client(name), want.client(name)
        shared = [c for c in two.columns if c in one.columns]
        assert {"respondent_id", "venue_name", "total_expenditure_response"} & set(shared) == {"respondent_id", "venue_name"} | (
            {"total_expenditure_response"} & set(one.columns))
        rows = lambda df: sorted(repr(tuple(r)) for r in df.select(*shared).collect())
        assert rows(one) == rows(two)


def test_one_folder_may_hold_both_layouts(spark):
    root = tempfile.mkdtemp(prefix="visitlens-both-")
    os.makedirs(os.path.join(root, "c"))
    write_csv(os.path.join(root, "c", "two.csv"), [["Respondent ID", "Food"], ["", "Rating"], ["1", "Good"]])
    write_csv(os.path.join(root, "c", "one.csv"), [["Respondent ID", "Food Rating"], ["2", "Poor"], ["3", "Fair"]])
    assert answers(I.read_cells(spark, root)) == [
        ("c", "one", 0, "2", "Food Rating", "Poor"), ("c", "one", 0, "2", "Respondent ID", "2"), ("c", "one", 1, "3", "Food Rating", "Fair"),
        ("c", "one", 1, "3", "Respondent ID", "3"), ("c", "two", 0, "1", "Food Rating", "Good"), ("c", "two", 0, "1", "Respondent ID", "1")]
