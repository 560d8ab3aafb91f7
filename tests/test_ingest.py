"""Files -> cells -> header dictionary -> recoded client masters, and sinks."""

import os
import tempfile
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import functions as F

from visitlens.plans.build import build_masters
from visitlens.sources import ingest as I
from visitlens.sinks.writers import column_types, write_client_masters, write_each, write_each_client

TOP = ["Respondent ID", "How likely would you be to recommend this establishment?",
       "Please enter your details here:", "Thinking about the staff, please select the words that best describe them",
       "", "Total expenditure", "IMPORTANT: check for typos before you submit"]
SUB = ["", "Response", "Gender:", "Adept", "Awkward", "Response", ""]


def col_letter(i):
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def write_xlsx(path, rows):
    sheet = ['<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/'
             'spreadsheetml/2006/main"><sheetData>']
    for r, row in enumerate(rows, start=1):
        sheet.append(f'<row r="{r}">')
        for c, v in enumerate(row):
            if v is None or v == "":
                continue
            ref = f"{col_letter(c)}{r}"
            if isinstance(v, (int, float)):
                sheet.append(f'<c r="{ref}"><v>{v}</v></c>')
            else:
                sheet.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(v)}</t></is></c>')
        sheet.append("</row>")
    sheet.append("</sheetData></worksheet>")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", "".join(sheet))


def write_csv(path, rows):
    import csv
    with open(path, "w", newline="") as fh:
        csv.writer(fh).writerows(rows)


def make_tree():
    root = tempfile.mkdtemp(prefix="visitlens-ingest-")
    for client in ("client_a", "client_b"):
        os.makedirs(os.path.join(root, client))
    write_xlsx(os.path.join(root, "client_a", "Venue_One_iGUEST-Survey v2.1.xlsx"),
               [TOP, SUB, [101, "Very likely", " f", "Yes", None, "$12.50", None],
                [102, "Not very likely", "MALE", None, "1", "AUD 1,250.00", None]])
    write_csv(os.path.join(root, "client_b", "Venue Two Survey.csv"),
              [TOP[:-1], SUB[:-1], ["201", "Quite likely", "other", "", "", "n/a"]])
    with open(os.path.join(root, "client_b", "broken.xlsx"), "wb") as fh:
        fh.write(b"not a zip file")
    write_csv(os.path.join(root, "top_level.csv"), [TOP, SUB, ["9"] * 7])
    return root


def test_build_masters_end_to_end(spark):
    root = make_tree()
    m = build_masters(spark, root, likert=[])
    rows = {r["respondent_id"]: r.asDict() for r in m.masters.collect()}
    assert set(rows) == {"101", "102", "201"}
    rec = "how_likely_would_you_be_to_recommend_this_establishment_respons"  # cut to 63
    assert rows["101"][rec] == 2.0 and rows["102"][rec] == 0.0 and rows["201"][rec] == 1.0
    assert rows["101"]["please_enter_your_details_here_gender"] == "Female"
    assert rows["201"]["please_enter_your_details_here_gender"] is None
    adept = "thinking_about_the_staff_please_select_the_words_that_best_desc"
    awkward = "thinking_about_the_staff_please_select_the_words_that_best_de_1"
    assert (rows["101"][adept], rows["101"][awkward]) == (1, 0)
    assert (rows["102"][adept], rows["102"][awkward]) == (0, 1)
    assert rows["101"]["total_expenditure_response"] == 12.5
    assert rows["102"]["total_expenditure_response"] == 1250.0
    assert rows["101"]["venue_name"] == "Venue One" and rows["201"]["venue_name"] == "Venue Two"
    assert rows["101"]["client_id"] == "C001" and rows["201"]["client_id"] == "C002"
    assert m.masters.columns[:3] == ["client_id", "client_name", "venue_name"]
    assert not any("important" in c for c in m.masters.columns)
    q = m.quarantine.collect()
    assert len(q) == 1 and q[0].path.endswith("broken.xlsx")


def test_write_masters_and_status(spark):
    root = make_tree()
    m = build_masters(spark, root, likert=[])
    out = tempfile.mkdtemp(prefix="visitlens-out-")
    write_each_client(m.each(), os.path.join(out, "masters"))
    from visitlens.sources.catalog import read_client_masters
    back = read_client_masters(spark, os.path.join(out, "masters"))
    assert back.count() == 3
    assert sorted(back.columns) == sorted(m.masters.columns)
    cols = sorted(m.masters.columns)
    assert back.select(*cols).exceptAll(m.masters.select(*cols)).count() == 0
    # rewriting one client only touches its partition
    write_client_masters(m.masters.where(F.col("client_name") == "client_b"), os.path.join(out, "masters"))
    assert read_client_masters(spark, os.path.join(out, "masters")).count() == 3
    status = write_each(spark, {"good": m.masters, "bad": m.masters},
                        lambda name, df: (_ for _ in ()).throw(ValueError("boom")) if name == "bad"
                        else df.write.mode("overwrite").parquet(os.path.join(out, name)))
    st = {r.table: r.ok for r in status.collect()}
    assert st == {"good": True, "bad": False}
    types = column_types(m.masters.select("respondent_id", "total_expenditure_response"))
    assert types == '"respondent_id" TEXT, "total_expenditure_response" DOUBLE PRECISION'


def test_prepare_for_sql(spark):
    from visitlens.sinks.writers import prepare_for_sql
    df = spark.createDataFrame([(1.0, float("nan"), "x", "y")], ["a", "A", "a 1", "3rd?"])
    out = prepare_for_sql(df)
    assert out.columns == ["a", "a_1", "a_1_1", "col_3rd"]
    assert out.collect()[0].a_1 is None


def test_save_table_refresh_and_append(spark):
    from visitlens.sinks.writers import save_table
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    save_table(df, "vl_t_refresh")
    save_table(df, "vl_t_refresh", mode="append")
    assert spark.table("vl_t_refresh").count() == 2
    save_table(df.withColumn("extra", F.lit(1.5)), "vl_t_refresh")  # full refresh, new schema
    t = spark.table("vl_t_refresh")
    assert t.count() == 1 and "extra" in t.columns


def test_register_views_in_order(spark):
    from paths import SF_SMALL
    from visitlens.plans.views import VIEW_NAMES, register_views
    from visitlens.sources import fixtures as fx
    names = register_views(spark, fx.section_scores_wide(spark, SF_SMALL), fx.feedback_service(spark, SF_SMALL),
                           {"fx_comment_master": fx.comment_master(spark, SF_SMALL)})
    assert names == VIEW_NAMES
    assert spark.table("vw_report_base_powerbi").count() == spark.table("vw_powerbi_master_final").count()
    assert spark.sql("select count(*) from vw_staff_service_words_powerbi").collect()[0][0] == 0


def test_write_client_tables(spark):
    from visitlens.sinks.writers import save_table, write_client_tables
    root = make_tree()
    m = build_masters(spark, root, likert=[])
    status = write_client_tables(spark, m.masters, lambda name, df: save_table(df, name))
    assert sorted((r.table, r.ok) for r in status.collect()) == [("client_a_master", True),
                                                                 ("client_b_master", True)]
    assert spark.table("client_a_master").count() == 2


def test_files_to_report_views(spark):
    """Files -> recoded masters -> section scores -> report views."""
    from visitlens.operators.scoring import build_section_scores
    from visitlens.plans import views
    root = tempfile.mkdtemp(prefix="visitlens-e2e-")
    os.makedirs(os.path.join(root, "client_x"))
    top = ["Respondent ID", "Assessor ID", "Visit Type", "Visit Date", "Welcome", "Farewell", "Welcome"]
    sub = ["", "", "", "", "Rating", "Rating", "Comments"]
    write_xlsx(os.path.join(root, "client_x", "Harbour Bar (1) Survey v2.xlsx"),
               [top, sub, [11, 3, "Dinner", "01/06/2024", "Very Good", "good", "Lovely"],
                [12, 3, "Lunch", "02/06/2024", "poor", "n/a", " n/a "]])
    m = build_masters(spark, root)
    master = m.masters.withColumnRenamed("visit_date", "visit_date_raw")
    spec = {"service_score": {"service_arrival_score": ["welcome_rating"],
                              "service_departure_score": ["farewell_rating"]}}
    wide = build_section_scores(master, spec)
    for s, total in (("selling", "selling_score"), ("product", "product_score"),
                     ("environment", "environment_score")):
        wide = wide.withColumn(total, F.lit(None).cast("double"))
    out = {r.respondent_id: r for r in views.master_view(wide).collect()}
    assert out["11"].venue_name == "Harbour Bar" and out["12"].visit_rank == 1 and out["11"].visit_rank == 2
    assert out["11"].total_score == 83.3 and out["12"].total_score == 0.0
    assert out["12"].performance_band == "Critical" and out["11"].assessor_id == "3"
    comments = views.comments_view(spark, {"client_x_master": master.withColumnRenamed(
        "welcome_comments", "welcome_comments")}).collect()
    assert [(c.respondent_id, c.comment_text) for c in comments] == [("11", "Lovely")]


def test_long_answers_give_same_comments_and_words(spark):
    from visitlens.plans import master as M
    from visitlens.plans import views
    root = tempfile.mkdtemp(prefix="visitlens-long-")
    os.makedirs(os.path.join(root, "client_y"))
    top = ["Respondent ID", "Welcome", "Farewell", "Thinking about the staff, please select the words "
           "that best describe them", ""]
    sub = ["", "Comments", "Comments", "Adept", "Awkward"]
    write_csv(os.path.join(root, "client_y", "Dock (2).csv"),
              [top, sub, ["1", "Great", " n/a ", "Yes", ""], ["2", "", "Bye ", "", "1.0"]])
    cells, _ = I.split_errors(I.decode_cells(I.list_files(spark, root)))
    d = M.client_dictionary(I.header_cells(cells))
    ans = I.answer_cells(cells)
    plan = ans._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Join" not in plan
    wide = M.pivot_client(ans, d, "client_y")
    key = lambda r: tuple(str(x) for x in r)
    a = sorted(views.comments_from_answers(spark, M.named_answers(ans, d)).collect(), key=key)
    b = sorted(views.comments_view(spark, wide).collect(), key=key)
    assert a == b and [r.comment_text for r in a] == ["Great", "Bye "]
    a = sorted(views.staff_words_from_answers(spark, ans).collect(), key=key)
    b = sorted(views.staff_words_view(spark, wide).collect(), key=key)
    assert a == b and len(a) == 2


def drift_tree(spark):
    root = tempfile.mkdtemp(prefix="visitlens-drift-")
    for client in ("acme", "beta"):
        os.makedirs(os.path.join(root, client))
    ask = "Thinking about the staff, please select the words that best describe them"
    write_csv(os.path.join(root, "acme", "a.csv"), [["Respondent ID", ask, "", "", "Food"], ["", "Adept", "Awkward", "Confident", "Rating"],
                                                    ["1", "Yes", "1", "", "Good"]])
    write_csv(os.path.join(root, "acme", "b.csv"), [["Respondent ID", ask, "", "Food", "Venue Name"], ["", "Adept", "Confident", "Rating", ""],
                                                    ["2", "", "true", "rather salty", "Other place"]])
    write_csv(os.path.join(root, "beta", "c.csv"), [["Respondent ID", "Food", "Extra"], ["", "Rating", ""], ["3", "poor", "x"]])
    return root


def test_drifting_files_keep_their_words(spark):
    from visitlens.plans import views
    m = build_masters(spark, drift_tree(spark), likert=[])
    words = {(r.respondent_id, r.word_label) for r in views.staff_words_from_answers(spark, m.answers).collect()}
    assert words == {("1", "Adept"), ("1", "Awkward"), ("2", "Confident")}
    acme, beta = m.client("acme"), m.client("beta")
    base = "thinking_about_the_staff_please_select_the_words_that_best_des"
    assert acme.columns == ["client_id", "client_name", "venue_name", "respondent_id", base + "c", base[:-1] + "_1",
                            base[:-1] + "_2", "food_rating", "venue_name_1"]
    rows = {r["respondent_id"]: r for r in acme.collect()}
    assert rows["2"][base[:-1] + "_2"] == 1 and rows["2"]["venue_name_1"] == "Other place" and rows["2"]["venue_name"] == "b"
    assert beta.columns == ["client_id", "client_name", "venue_name", "respondent_id", "food_rating", "extra"]


def test_likert_is_judged_per_file(spark):
    m = build_masters(spark, drift_tree(spark))
    assert {r.respondent_id: r.food_rating for r in m.client("acme").collect()} == {"1": "2.0", "2": "rather salty"}
    assert m.client("beta").first().food_rating == 0.0
    root = tempfile.mkdtemp(prefix="visitlens-likert-")
    os.makedirs(os.path.join(root, "c"))
    write_csv(os.path.join(root, "c", "a.csv"), [["Respondent ID", "First Name"], ["", ""], ["1", "Good"]])
    assert build_masters(spark, root).client("c").first().first_name == "Good"


def test_drifting_clients_round_trip(spark):
    from visitlens.sources.catalog import read_client_masters
    m = build_masters(spark, drift_tree(spark))
    out = os.path.join(tempfile.mkdtemp(prefix="visitlens-out-"), "masters")
    write_each_client(m.each(), out)
    back = {r["respondent_id"]: r for r in read_client_masters(spark, out).collect()}
    assert back["3"]["extra"] == "x" and back["1"]["extra"] is None and back["2"]["venue_name_1"] == "Other place"


def test_large_bad_file_is_rejected_whole(spark):
    root = tempfile.mkdtemp(prefix="visitlens-bad-")
    os.makedirs(os.path.join(root, "c"))
    good, bad = os.path.join(root, "c", "good.xlsx"), os.path.join(root, "c", "bad.xlsx")
    write_xlsx(good, [["Respondent ID"], [""], *[[str(i)] for i in range(60_000)]])
    with zipfile.ZipFile(good) as z:
        sheet = z.read("xl/worksheets/sheet1.xml").decode()
    with zipfile.ZipFile(bad, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet[:-40])
    cells, quarantine = I.split_errors(I.decode_cells(I.list_files(spark, root)))
    assert [r.path.endswith("bad.xlsx") for r in quarantine.collect()] == [True]
    assert cells.where(F.col("path").endswith("bad.xlsx")).count() == 0
    assert cells.where("row_id >= 0").count() == 60_000


def test_clients_with_one_table_name_are_reported(spark):
    from visitlens.sinks.writers import write_client_tables
    df = spark.createDataFrame([("Acme Bar", 1), ("acme-bar", 2), ("Other", 3)], "client_name string, v long")
    wrote = []
    status = write_client_tables(spark, df, lambda name, frame: wrote.append((name, frame.count()))).collect()
    assert sorted((r.table, r.ok) for r in status) == [("acme_bar_master", False), ("acme_bar_master", False), ("other_master", True)]
    assert wrote == [("other_master", 1)]


def test_client_ids_never_change_hands(spark):
    from visitlens.plans.master import client_dimension
    first = client_dimension(spark.createDataFrame([("b",), ("d",)], "client_name string"))
    later = client_dimension(spark.createDataFrame([("a",), ("b",), ("c",)], "client_name string"), known=first)
    assert {r.client_name: r.client_id for r in later.collect()} == {"b": "C001", "d": "C002", "a": "C003", "c": "C004"}


def test_cells_without_references():
    import io as _io

    from visitlens.sources.decoders import xlsx_cells
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    sheet = (f'<worksheet {ns}><sheetData><row><c><v>1</v></c><c><v>2</v></c></row>'
             '<row r="3"><c r="C3"><v>3</v></c><c><v>4</v></c></row></sheetData></worksheet>')
    buf = _io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    assert list(xlsx_cells(buf.getvalue())) == [(0, 0, "1"), (0, 1, "2"), (2, 2, "3"), (2, 3, "4")]


def test_name_helpers_agree(spark):
    from visitlens.functions import text
    names = [" First  Name ", "3rd?", "a__b", "Éa-b", "", "col_1", "A" * 80 + "!"]
    tops = ["Unnamed: 3_level_0", "Top ", "Top"]
    df = spark.createDataFrame([(n, t) for n in names for t in tops], "n string, t string")
    for r in df.select("n", "t", text.clean_identifier(F.col("n"), max_len=63).alias("a"), text.flatten_header("t", "n").alias("h")).collect():
        assert (r.a, r.h) == (text.identifier(r.n, 63), text.header_text(r.t, r.n))


def test_xlsx_decoder_shared_and_rich_strings():
    import io as _io

    from visitlens.sources.decoders import csv_cells, xlsx_cells
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    ss = (f'<sst {ns}><si><t>plain</t></si><si><r><t>ri</t></r><r><t>ch</t></r>'
          '<rPh><t>x</t></rPh></si></sst>')
    sheet = (f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c>'
             '<c r="B1" t="s"><v>1</v></c><c r="AA1"><v>3.5</v></c><c r="AB1" t="b"><v>1</v></c>'
             '</row></sheetData></worksheet>')
    buf = _io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/sharedStrings.xml", ss)
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    assert list(xlsx_cells(buf.getvalue())) == [(0, 0, "plain"), (0, 1, "rich"), (0, 26, "3.5"), (0, 27, "True")]
    assert list(csv_cells(b'a,"b,c",\r\n1,,x')) == [(0, 0, "a"), (0, 1, "b,c"), (0, 2, None),
                                                    (1, 0, "1"), (1, 1, None), (1, 2, "x")]


def test_xlsx_date_cells_become_iso_text():
    import io as _io

    from visitlens.sources.decoders import xlsx_cells
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    styles = (f'<styleSheet {ns}><numFmts><numFmt numFmtId="164" formatCode="dd/mm/yyyy"/></numFmts>'
              '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="2"/>'
              '</cellXfs></styleSheet>')
    sheet = (f'<worksheet {ns}><sheetData><row r="1"><c r="A1" s="1"><v>45444</v></c>'
             '<c r="B1" s="2"><v>45444.5</v></c><c r="C1" s="3"><v>45444</v></c>'
             '<c r="D1" s="1"><v>0.8125</v></c></row></sheetData></worksheet>')
    buf = _io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/styles.xml", styles)
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    assert list(xlsx_cells(buf.getvalue())) == [(0, 0, "2024-06-01"), (0, 1, "2024-06-01 12:00:00"),
                                                (0, 2, "45444"), (0, 3, "19:30:00")]


def test_register_views_with_unified_master(spark):
    from paths import SF_SMALL
    from visitlens.plans.views import register_views
    from visitlens.sources import fixtures as fx
    master = fx.comment_master(spark, SF_SMALL)
    register_views(spark, fx.section_scores_wide(spark, SF_SMALL), fx.feedback_service(spark, SF_SMALL), master)
    sources = {r[0] for r in spark.sql("select distinct source_table from vw_comments_powerbi").collect()}
    assert sources and all(s.startswith("client_") and s.endswith("_master") for s in sources)
