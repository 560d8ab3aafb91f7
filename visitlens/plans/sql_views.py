"""The report layer as persistent catalog views.

``plans.views`` gives the reports as frames; here they are views of a database,
which every session of the catalog sees. A view's SQL names what it reads in
braces, so the dependency graph is read from the definitions; views are created in
topological order, and replacing one re-creates every view that reads it, or puts
all of them back if one no longer fits. Definitions can be kept beside the tables
and restored into an empty catalog.
"""

from __future__ import annotations

import json
from graphlib import TopologicalSorter
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from visitlens import config
from visitlens.sinks.writers import save_table

SECTION_VIEWS = {"service": "vw_service_score", "selling": "vw_selling_score", "product": "vw_product_score",
                 "environment": "vw_environment_score"}
FEEDBACK = "vw_feedback_service_all"
VISIT = ["client_name", "venue_name", "respondent_id", "assessor_id", "visit_type", "visit_date_raw"]
TOTALS = {section: total for section, (total, _) in config.SECTION_COLUMNS.items()}
DEC = "decimal(38,6)"


def quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _listed(values) -> str:
    return ", ".join(map(quoted, values))


def _ladder(score: str, bands, rest: str) -> str:
    return "case " + " ".join(f"when {score} >= {least} then {quoted(label)}" for least, label in bands) + f" else {quoted(rest)} end"


_VENUE = r"trim(regexp_replace(cast(venue_name as string), r'\s*\(\d+\)$', ''))"
_ID = f"concat_ws('|', cast(client_name as string), {_VENUE}, cast(respondent_id as string)) as visit_id"
_KEYS = f"{_ID}, cast(client_name as string) as client_name, {_VENUE} as venue_name, cast(respondent_id as string) as respondent_id"


def _total_score() -> str:
    branches = " union all ".join(
        f"select {', '.join(VISIT)}, " + ", ".join(f"cast({t if s == section else 'null'} as double) as {t}" for s, t in TOTALS.items())
        + f" from {{{view}}}" for section, view in SECTION_VIEWS.items())
    best = ", ".join(f"round(cast(max({t}) as {DEC}), 1) as {t}" for t in TOTALS.values())
    total = " + ".join(f"coalesce({t}, cast(0 as {DEC}))" for t in TOTALS.values())
    present = " + ".join(f"if({t} is null, 0, 1)" for t in TOTALS.values())
    words = "|".join(config.EXCLUDED_VENUE_WORDS)
    scores = ", ".join(f"cast({t} as double) as {t}" for t in TOTALS.values())
    return rf"""
with best as (select {', '.join(VISIT)}, {best} from ({branches}) group by {', '.join(VISIT)})
select {_KEYS}, venue_name as venue_name_original, trim(split_part(cast(assessor_id as string), '.', 1)) as assessor_id,
  visit_type, visit_date_raw, try_to_date(visit_date_raw, 'dd/MM/yyyy') as visit_date, {scores},
  cast(round(cast(({total}) / nullif({present}, 0) as {DEC}), 1) as double) as total_score, cast(assessor_id as string) as assessor_id_raw
from best
where visit_date_raw rlike r'\A\d{{{{2}}}}/\d{{{{2}}}}/\d{{{{4}}}}\z'
  and try_to_date(visit_date_raw, 'dd/MM/yyyy') between date {quoted(config.VISIT_DATE_FLOOR)} and date '2100-12-31'
  and not lower(venue_name) rlike {quoted(words)}"""


_SHOWN = ("visit_id, client_name, venue_name, venue_name_original, respondent_id, assessor_id, visit_type, visit_date_raw, visit_date, "
          + ", ".join(TOTALS.values()) + ", total_score")


def _master() -> str:
    first, (low, high) = config.LATEST_RANK, config.PREVIOUS_RANKS
    ties = ", ".join(f"{c} asc nulls first" for c in ("venue_name_original", "assessor_id", "assessor_id_raw", "visit_type", "visit_date_raw"))
    return f"""
select {_SHOWN}, visit_rank, visit_rank = {first} as is_latest_visit, visit_rank between {low} and {high} as is_previous_10_visits,
  case when visit_rank = {first} then {quoted(config.VISIT_GROUP_LATEST)} when visit_rank between {low} and {high}
    then {quoted(config.VISIT_GROUP_PREVIOUS)} else {quoted(config.VISIT_GROUP_OLDER)} end as visit_group,
  {_ladder('total_score', config.PERFORMANCE_BANDS, config.PERFORMANCE_BAND_ELSE)} as performance_band
from (select *, cast(row_number() over (partition by client_name, venue_name order by visit_date desc nulls last,
  respondent_id desc nulls first, {ties}) as bigint) as visit_rank from {{vw_total_score_keyed}})"""


def _labelled(labels, select: str, value: str, where: str) -> str:
    """Labelled section columns in long form: one scan and one generator a section."""
    found = []
    for section, view in SECTION_VIEWS.items():
        own = [r for r in labels if r[1] in config.SECTION_COLUMNS[section][1]]
        if own:
            cells = ", ".join(f"{quoted(group)}, {quoted(label)}, cast({c} as double)" for group, c, label in own)
            ids = "client_name, venue_name, respondent_id, assessor_id, visit_date_raw"
            found.append(f"select {select} from (select {ids}, stack({len(own)}, {cells}) as (section, label, {value}) from {{{view}}}) {where}")
    return " union all ".join(found)


def _question_scores() -> str:
    return _labelled(config.QUESTION_LABELS, f"{_KEYS}, cast(assessor_id as string) as assessor_id, visit_date_raw, section, label as question_name, "
                     f"cast(round(cast(answer as {DEC}), 2) as double) as question_score", "answer", "where answer is not null")


def _question_ratings() -> str:
    rating = _ladder("question_score", config.RATING_BANDS, config.RATING_BAND_ELSE)
    return f"select *, if(question_score is null, null, {rating}) as rating from {{vw_question_scores}}"


def _section_breakdown() -> str:
    return _labelled(config.BREAKDOWN_LABELS, f"{_KEYS}, section, label as category, answer as score", "answer", "")


def _staff_behaviour() -> str:
    cells = ", ".join(f"{quoted(label)}, cast({c} as string)" for c, label in config.STAFF_METRICS)
    number, scale = "try_cast(answer as double)", config.STAFF_SCALE_MAX
    return rf"""
select {_KEYS}, cast(assessor_id as string) as assessor_id, visit_date_raw, {quoted(config.STAFF_SECTION)} as section, behaviour_metric,
  case when abs({number}) < 1e28 then cast(round(cast(answer as {DEC}) / cast({scale} as decimal(2,1)) * 100, 2) as double)
    else round({number} / {float(scale)} * 100, 2) end as score
from (select client_name, venue_name, respondent_id, assessor_id, visit_date_raw,
  stack({len(config.STAFF_METRICS)}, {cells}) as (behaviour_metric, answer) from {{{FEEDBACK}}})
where answer rlike r'\A\d+(\.\d+)?\z'"""


def _mapped(tables: dict[str, list[str]], rows, names: list[str], select: str, where: str, empty: str) -> str:
    """Mapped columns of every table that has them, in long form; an empty typed
    relation without any."""
    found = []
    for table, columns in tables.items():
        own = [r for r in rows if r[2] in columns]
        if own:
            cells = ", ".join(f"{quoted(a)}, {quoted(b)}, cast({c} as string)" for a, b, c in own)
            found.append(f"select {_KEYS}, {', '.join(names)}, {select}, {quoted(table)} as source_table from (select client_name, venue_name, "
                         f"respondent_id, stack({len(own)}, {cells}) as ({', '.join(names)}, answer) from {{{table}}}) where {where}")
    none = ", ".join(f"cast(null as string) as {c}" for c in ("visit_id", "client_name", "venue_name", "respondent_id", *names))
    return " union all ".join(found) or f"select {none}, {empty}, cast(null as string) as source_table where false"


def _comments(tables: dict[str, list[str]]) -> str:
    where = f"answer is not null and trim(answer) <> '' and lower(trim(answer)) not in ({_listed(config.NULL_TOKENS)})"
    return _mapped(tables, config.COMMENT_MAP, ["section", "comment_type"], "answer as comment_text", where, "cast(null as string) as comment_text")


def _words(tables: dict[str, list[str]]) -> str:
    where = f"trim(answer) in ({_listed(config.TRUTHY_TOKENS)})"
    return _mapped(tables, config.WORD_MAP, ["word_group", "word_label"], "1 as selected_flag", where, "cast(null as int) as selected_flag")


def definitions(tables: dict[str, list[str]]) -> dict[str, str]:
    """SQL of the 13 report views, and of one that keeps the raw assessor by which
    ties are ranked; ``tables`` names the client masters and their columns."""
    shown = f"{_SHOWN}, visit_rank, is_latest_visit, is_previous_10_visits, visit_group, performance_band"
    comments = "visit_id, client_name, venue_name, respondent_id, section, comment_type, comment_text, source_table"
    return {
        "vw_total_score_keyed": _total_score(),
        "vw_total_score_final": f"select {_SHOWN} from {{vw_total_score_keyed}}",
        "vw_powerbi_master_final": _master(),
        "vw_latest_visit_score_final": "select * from {vw_powerbi_master_final} where is_latest_visit",
        "vw_previous_visits_score_final": "select * from {vw_powerbi_master_final} where is_previous_10_visits",
        "vw_trend_score_final": "select * from {vw_powerbi_master_final}",
        "vw_question_scores": _question_scores(),
        "vw_question_scores_powerbi": _question_ratings(),
        "vw_section_breakdown_final": _section_breakdown(),
        "vw_staff_behaviour_powerbi": _staff_behaviour(),
        "vw_full_survey_comments_powerbi": _comments(tables),
        "vw_comments_powerbi": f"select {comments} from {{vw_full_survey_comments_powerbi}}",
        "vw_staff_service_words_powerbi": _words(tables),
        "vw_report_base_powerbi": f"select {shown} from {{vw_powerbi_master_final}}",
    }


def reads(sql: str) -> set[str]:
    """Names in braces: the tables and views that a definition reads."""
    return {name for _, name, _, _ in Formatter().parse(sql) if name}


class ReportCatalog:
    """Views of one database, by their definitions."""

    def __init__(self, spark: SparkSession, database: str, views: dict[str, str] | None = None):
        self.spark, self.database, self.views = spark, database, dict(views or {})

    def save_tables(self, scores: DataFrame, feedback: DataFrame, masters: dict[str, DataFrame]) -> None:
        """Saves the inputs as tables and defines the views over them.

        ``scores`` is one wide frame of all sections, written once per section
        with that section's columns.
        """
        for section, (total, columns) in config.SECTION_COLUMNS.items():
            self._save(scores.select(*VISIT, *columns, total), SECTION_VIEWS[section])
        self._save(feedback, FEEDBACK)
        for name, df in masters.items():
            self._save(df, name)
        self.views = definitions({name: df.columns for name, df in masters.items()})

    def _save(self, df: DataFrame, name: str) -> None:
        save_table(df, f"{self.database}.{name}")

    def order(self) -> list[str]:
        """The views, each after those that it reads; a cycle is an error."""
        graph = {name: reads(sql) & self.views.keys() for name, sql in self.views.items()}
        return list(TopologicalSorter(graph).static_order())

    def readers(self, name: str) -> set[str]:
        """All views that read ``name``, directly or through others."""
        found: set[str] = set()
        for view in self.order():
            if reads(self.views[view]) & {name, *found}:
                found.add(view)
        return found

    def create(self, names: set[str] | None = None) -> list[str]:
        """(Re)creates the named views (all by default) in dependency order."""
        made = [name for name in self.order() if names is None or name in names]
        for name in made:
            sql = self.views[name].format_map({n: f"{self.database}.{n}" for n in reads(self.views[name])})
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{name} AS {sql}")
        return made

    def replace(self, name: str, sql: str) -> list[str]:
        """Gives a view another definition and re-creates what reads it.

        If one of them does not fit the new one, all get their old form back.
        """
        before = dict(self.views)
        self.views[name] = sql
        touched = {name} | self.readers(name)
        try:
            return self.create(touched)
        except Exception:
            self.views = before
            if name in before:
                self.create(touched)
            else:
                self.spark.sql(f"DROP VIEW IF EXISTS {self.database}.{name}")
            raise

    def drop(self) -> None:
        """Drops the views, those that read others first."""
        for name in reversed(self.order()):
            self.spark.sql(f"DROP VIEW IF EXISTS {self.database}.{name}")

    def store(self, path: str) -> None:
        """Keeps the definitions at ``path`` (a small file on any store of Spark's)."""
        text = json.dumps(self.views)
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def restore(cls, spark: SparkSession, database: str, path: str) -> ReportCatalog:
        """The catalog that ``store`` kept, with its views created anew."""
        text = spark.read.text(path, wholetext=True).first()[0]
        out = cls(spark, database, json.loads(text))
        out.create()
        return out
