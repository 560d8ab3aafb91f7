"""Reference SQL (DuckDB) for the recoder, header and master queries."""

from __future__ import annotations

from visitlens import config
from visitlens.sources.fixture_sql import with_fixtures

_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"


def pystrip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def clean(x: str) -> str:
    return f"lower({pystrip(f'cast({x} as varchar)')})"


def case_map(expr: str, mapping: dict, cast: str | None = None) -> str:
    whens = " ".join(f"when '{k}' then {v!r}" if isinstance(v, str) else f"when '{k}' then {v}"
                     for k, v in mapping.items())
    out = f"case {expr} {whens} end"
    return f"cast({out} as {cast})" if cast else out


def clean_identifier(x: str) -> str:
    s = f"lower({x})"
    s = f"regexp_replace({s}, '[^a-z0-9]+', '_', 'g')"
    s = f"regexp_replace({s}, '_+', '_', 'g')"
    s = f"regexp_replace({s}, '^_+|_+$', '', 'g')"
    return f"(case when regexp_matches({s}, '^[0-9]') then concat('col_', {s}) else {s} end)"


def recommendation() -> str:
    t = clean("q_recommend")
    return with_fixtures(
        f"select respondent_id, cast(case when contains({t}, 'not very likely') then 0 "
        f"when contains({t}, 'very likely') then 2 when contains({t}, 'quite likely') then 1 end "
        "as double) as q_recommend from fx_survey_wide")


def speed_expr(col: str, mapping: dict) -> str:
    t = clean(col)
    return (f"cast(case when {t} in ('n/a', 'na') then null else "
            f"{case_map(t, mapping)} end as double)")


def speed() -> str:
    return with_fixtures(f"select respondent_id, {speed_expr('q_drinks_speed', config.DRINKS_ORDER_MAP)} "
                         "as q_drinks_speed from fx_survey_wide")


def gender_expr(col: str) -> str:
    return case_map(clean(col), config.GENDER_MAP)


def gender() -> str:
    return with_fixtures(f"select respondent_id, {gender_expr('q_gender')} as q_gender from fx_survey_wide")


_WORD_COLS = [
    "thinking_about_the_staff_please_select_the_words_that_best_desc",
    "thinking_about_the_staff_please_select_the_words_that_best_de_1",
    "please_select_the_words_that_best_describe_the_service_that_you",
    "please_select_the_words_that_best_describe_the_service_that_y_1",
]


def staff_binary() -> str:
    cols = ", ".join(
        f"cast(case when {c} is not null and {pystrip(c)} <> '' then 1 else 0 end as integer) as {c}"
        for c in _WORD_COLS)
    return with_fixtures(f"select respondent_id, {cols} from fx_word_master")


_SURVEY_COLS = ["client_name", "venue_name", "respondent_id", "q_clean", "q_mixed", "q_only_na",
                "q_empty", "q_recommend", "q_drinks_speed", "q_gender", "staff_word_checkbox",
                "q_number"]
_DOMAIN = "('poor', 'fair', 'good', 'very good', 'n/a')"


def likert_columns() -> str:
    parts = []
    for c in _SURVEY_COLS:
        if c.replace("_", " ") in [m.lower() for m in config.METADATA_COLUMNS]:
            continue  # metadata is never a question
        parts.append(
            f"select '{c}' as column_name, cast(count({c}) as bigint) as n_values, "
            f"(coalesce(bool_and({clean(c)} in {_DOMAIN}), false) and count({c}) > 0) as is_likert "
            "from fx_survey_wide")
    return with_fixtures("\nunion all\n".join(parts))


def likert() -> str:
    cols = ", ".join(f"{case_map(clean(c), config.LIKERT_MAP, 'double')} as {c}"
                     for c in ["q_clean", "q_only_na"])
    return with_fixtures(f"select respondent_id, {cols} from fx_survey_wide")


def value_counts() -> str:
    rec = (f"rec as (select {gender_expr('q_gender')} as q_gender, "
           f"{speed_expr('q_drinks_speed', config.DRINKS_ORDER_MAP)} as q_drinks_speed from fx_survey_wide)")
    q = ("select 'q_gender' as column_name, q_gender as value, count(*) as n from rec group by q_gender "
         "union all select 'q_drinks_speed' as column_name, cast(q_drinks_speed as varchar) as value, "
         "count(*) as n from rec group by q_drinks_speed")
    return with_fixtures(q, rec)


def nan_to_null() -> str:
    return with_fixtures("select respondent_id, case when isnan(q_number) then null else q_number end "
                         "as q_number from fx_survey_wide")


def spend() -> str:
    return with_fixtures("select respondent_id, try_cast(regexp_replace(total_expenditure, '[^0-9.]', '', 'g') "
                         "as double) as total_expenditure from fx_raw_text")


def arrival_time() -> str:
    s = (f"upper(regexp_replace(replace(replace(lower({pystrip('time_you_arrived')}), ' ', ''), ':', '.'), "
         r"'^(\d{1,2})(am|pm)$', '\1.00\2'))")
    t = f"t as (select respondent_id, {s} as s from fx_raw_text)"
    q = ("select respondent_id, lower(strftime(coalesce(try_strptime(s, '%I.%M%p'), "
         "try_strptime(s, '%I.%M.%S%p')), '%-I.%M %p')) as time_you_arrived from t")
    return with_fixtures(q, t)


def parse_dates() -> str:
    """Dates by their parts: separators made alike, times cut off."""
    plain = f"regexp_replace({pystrip('date_of_visit')}, '[T\\s]+[0-9]{{1,2}}[:.][0-9]{{2}}.*$', '')"
    alike = f"regexp_replace({plain}, '[\\s./-]+', '-', 'g')"
    forms = ", ".join(f"try_strptime(d, '{form}')" for form in ("%Y-%m-%d", "%d-%m-%Y", "%d-%m-%y", "%d-%b-%Y", "%d-%B-%Y"))
    return with_fixtures(f"select respondent_id, cast(coalesce({forms}) as date) as date_of_visit "
                         f"from (select respondent_id, {alike} as d from fx_raw_text)")


def guests() -> str:
    words = ", ".join(f"'{k}': {v}" for k, v in config.NUMBER_WORDS.items())
    s = "lower(" + pystrip("replace(number_of_guests, '-', ' ')") + ")"
    w = (f"w as (select respondent_id, {pystrip('number_of_guests')} as raw, "
         f"list_filter(list_transform(string_split_regex({s}, '\\s+'), "
         f"lambda x: cast((MAP {{{words}}})[x] as bigint)), lambda v: v is not null) as vals from fx_raw_text)")
    fold = ("list_reduce(vals, lambda acc, v: case when v = 100 then {'t': acc.t, 'g': greatest(acc.g, 1) * 100} "
            "when v >= 1000 then {'t': acc.t + greatest(acc.g, 1) * v, 'g': 0} "
            "else {'t': acc.t, 'g': acc.g + v} end, {'t': 0::bigint, 'g': 0::bigint})")
    q = (f"select respondent_id, case when len(vals) > 0 then {fold}.t + {fold}.g "
         "when regexp_full_match(raw, '[+-]?[0-9]+(\\.[0-9]+)?') "
         "then cast(trunc(try_cast(raw as double)) as bigint) end as number_of_guests from w")
    return with_fixtures(q, w)


def _flattened() -> str:
    parts = ("concat_ws(' ', case when not contains(header_top, 'Unnamed') then header_top end, "
             "case when not contains(header_sub, 'Unnamed') then header_sub end)")
    return f"flat as (select file_id, col_ord, {pystrip(parts)} as header from fx_header)"


def _is_footer(h: str) -> str:
    t = f"lower({pystrip(h)})"
    return "(" + " or ".join(f"contains({t}, '{k}')" for k in config.FOOTER_KEYWORDS) + ")"


def _dropped() -> str:
    return (_flattened() + ",\nlast_col as (select file_id as f, max(col_ord) as last_ord, "
            "arg_max(header, col_ord) as last_header from flat group by file_id),\n"
            "kept as (select flat.* from flat where not exists (select 1 from last_col "
            "where last_col.f = flat.file_id and last_col.last_ord = flat.col_ord and "
            f"{_is_footer('last_col.last_header')}))")


def _unique() -> str:
    m = config.MAX_IDENTIFIER_LEN
    return (_dropped() + f",\nident as (select *, {clean_identifier('header')} as identifier from kept),\n"
            f"cand as (select *, substr(identifier, 1, {m}) as cand, row_number() over "
            f"(partition by file_id, substr(identifier, 1, {m}) order by col_ord) - 1 as k from ident),\n"
            "uniq as (select file_id, col_ord, identifier, case when k = 0 then cand else "
            f"concat(substr(identifier, 1, {m} - length(concat('_', cast(k as varchar)))), '_', cast(k as varchar)) "
            "end as unique_name from cand)")


def flatten_header() -> str:
    return with_fixtures("select file_id, col_ord, header from flat", _flattened())


def drop_footer() -> str:
    return with_fixtures("select file_id, col_ord, header from kept", _dropped())


def clean_identifier_q() -> str:
    return with_fixtures(f"select file_id, col_ord, header, {clean_identifier('header')} as identifier from flat",
                         _flattened())


def unique_identifiers() -> str:
    return with_fixtures("select file_id, col_ord, identifier, unique_name from uniq", _unique())


def table_profile() -> str:
    q = ("select file_id, count(*) as n_columns, count(*) - count(distinct identifier) as n_duplicate_identifiers, "
         "count(*) - count(distinct unique_name) as n_duplicate_names, "
         "cast(max(length(unique_name)) as integer) as max_name_length from uniq group by file_id")
    return with_fixtures(q, _unique())


def section_builder() -> str:
    lk = lambda c: case_map(clean(c), config.LIKERT_MAP, "double")
    t = clean("q_recommend")
    rec = (f"cast(case when contains({t}, 'not very likely') then 0 when contains({t}, 'very likely') then 2 "
           f"when contains({t}, 'quite likely') then 1 end as double)")

    def mean(cols):
        total = " + ".join(f"coalesce({c}, 0.0)" for c in cols)
        n = " + ".join(f"(case when {c} is not null then 1 else 0 end)" for c in cols)
        return f"(({total}) / nullif({n}, 0))"

    r = (f"r as (select client_name, venue_name, respondent_id, {lk('q_clean')} as a, {lk('q_only_na')} as b, "
         f"{rec} as c from fx_survey_wide)")
    arrival = f"({mean(['a', 'b'])} / 3.0 * 100)"
    verbal = f"({mean(['c'])} / 3.0 * 100)"
    q = (f"select client_name, venue_name, respondent_id, {arrival} as service_arrival_score, "
         f"{mean([arrival])} as service_score, {verbal} as selling_verbal_score, "
         f"{mean([verbal])} as selling_score from r")
    return with_fixtures(q, r)


def client_table_profile() -> str:
    name = clean_identifier("concat(client_name, '_master')")
    table = f"substr({name}, 1, {config.MAX_IDENTIFIER_LEN})"
    return with_fixtures(
        f"select {table} as table_name, client_name, count(*) as n_rows, 7 as n_columns, "
        "0 as n_duplicate_columns, 17 as max_column_length from fx_comment_master group by client_name")


def path_columns() -> str:
    base = "regexp_extract(path, '([^/]*)$', 1)"
    stem = f"regexp_replace({base}, '^(.*[^.].*)\\.[^.]*$', '\\1')"
    v = stem
    for pat in config.VENUE_STEM_PATTERNS:
        v = f"regexp_replace({v}, '{pat}', '', 'gi')"
    v = f"regexp_replace({v}, '[_\\-]+', ' ', 'g')"
    v = f"regexp_replace({v}, '\\s+', ' ', 'g')"
    client = "regexp_extract(path, '([^/]*)/[^/]*$', 1)"
    table = f"substr({clean_identifier(f'concat({client}, {chr(39)}_master{chr(39)})')}, 1, {config.MAX_IDENTIFIER_LEN})"
    return with_fixtures(f"select file_id, path, {client} as client_name, {pystrip(v)} as venue_name, "
                         f"{table} as table_name from fx_file")


def outer_union() -> str:
    return with_fixtures(
        "select respondent_id, client_name, venue_name, visit_type from fx_visit "
        "where substr(visit_type, 1, 1) in ('1', '2') "
        "union all by name select respondent_id, client_name, assessor_id, visit_date_raw from fx_visit "
        "where substr(visit_type, 1, 1) = '3' "
        "union all by name select client_name, respondent_id, venue_name, visit_date_raw, assessor_id "
        "from fx_visit where coalesce(substr(visit_type, 1, 1) not in ('1', '2', '3'), true)")


def client_ids() -> str:
    dim = ("dim as (select printf('C%03d', row_number() over (order by client_name)) as client_id, client_name "
           "from (select distinct client_name from fx_visit))")
    q = ("select d.client_id, v.client_name, v.venue_name, v.respondent_id, v.assessor_id, v.visit_type, "
         "v.visit_date_raw from fx_visit v left join dim d on v.client_name = d.client_name")
    return with_fixtures(q, dim)


def ingest_words() -> str:
    """Ticked words straight from the documents: no column names, no suffixes."""
    ticks = (("Adept", "length(text) % 2 = 0"), ("Awkward", "length(text) % 3 = 0 and doc_id % 2 = 0"),
             ("Confident", "length(text) % 5 < 2"))
    venue = "case when doc_id % 2 = 0 then 'full' else 'short' end"
    return " union all ".join(
        f"select source || '|' || {venue} || '|' || doc_id as visit_id, source as client_name, {venue} as venue_name, "
        f"cast(doc_id as varchar) as respondent_id, 'Staff Behaviour' as word_group, '{word}' as word_label, "
        f"cast(1 as integer) as selected_flag, source || '_master' as source_table from documents where {when}"
        for word, when in ticks)


def likert_by_file() -> str:
    scores = ", ".join(f"('{k}', {v})" for k, v in config.LIKERT_MAP.items())
    return (
        "with a as (select source as file_id, doc_id as respondent_id, lower(trim(case when length(source) % 2 = 0 and "
        "doc_id % 7 = 0 then text else ['Good', ' very good', 'n/a', 'Poor'][length(text) % 4 + 1] end)) as v "
        f"from documents), s as (select * from (values {scores}) t(k, score)), "
        f"f as (select a.*, coalesce(bool_and(v in (select k from s) or v = '{config.LIKERT_NA}') over (partition by file_id), "
        "false) as is_likert from a) select file_id, respondent_id, is_likert, "
        "cast(case when is_likert then score end as double) as likert_score from f left join s on v = k")


_LOAD_COLUMNS = ["visits", "amount", "visited", "stamped", "flag", "one_bad", "code", "long_number", "nothing", "impossible_day"]
_MISSING_WORDS = "('', '#n/a', '#n/a n/a', '#na', '-1.#ind', '-1.#qnan', '-nan', '1.#ind', '1.#qnan', '<na>', 'n/a', 'na', 'nan', 'none', 'null')"


def _plain_date(x: str) -> str:
    forms = ", ".join(f"try_strptime({x}, '{form}')" for form in ("%Y-%m-%d", "%d/%m/%Y", "%d-%m-%Y"))
    return f"coalesce({forms})"


def _moment(x: str) -> str:
    forms = ", ".join(f"try_strptime({x}, '{form}')" for form in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M"))
    return f"coalesce({forms}, {_plain_date(x)})"


def column_types() -> str:
    """Types by counting the values that each type can hold."""
    cells = "\nunion all\n".join(
        f"select client_name, '{c}' as column_name, {pystrip(c)} as v from fx_load" for c in _LOAD_COLUMNS)
    plain = "regexp_full_match(v, '[+-]?(0|[1-9][0-9]*)(\\.0+)?')"
    number = "regexp_full_match(v, '[+-]?((0|[1-9][0-9]*)(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?')"
    small = "try_cast(regexp_replace(v, '\\.0+$', '') as bigint) is not null"
    every = lambda test: f"bool_and({test}) filter (where v is not null)"
    q = f"""select client_name, column_name, count(v) as n_values,
  case when count(v) = 0 then 'empty' when {every("lower(v) in ('true', 'false')")} then 'bool'
       when {every(f"{plain} and {small}")} then 'int'
       when {every(f"{number} and (not {plain} or {small})")} then 'double'
       when {every(f"{_plain_date('v')} is not null")} then 'date'
       when {every(f"{_moment('v')} is not null")} then 'timestamp' else 'text' end as value_type
from (select client_name, column_name, case when lower(v) not in {_MISSING_WORDS} then v end as v from cells)
group by client_name, column_name"""
    return with_fixtures(q, f"cells as (\n{cells}\n)")


def typed_load() -> str:
    text = {c: f"(case when lower({pystrip(c)}) not in {_MISSING_WORDS} then {pystrip(c)} end)" for c in _LOAD_COLUMNS}
    return with_fixtures(f"""select respondent_id, client_name,
  cast(regexp_replace({text['visits']}, '\\.0+$', '') as bigint) as visits, cast({text['amount']} as double) as amount,
  cast({_plain_date(text['visited'])} as date) as visited, strftime({_moment(text['stamped'])}, '%Y-%m-%d %H:%M:%S') as stamped,
  lower({text['flag']}) = 'true' as flag, one_bad, code, long_number, nothing, impossible_day from fx_load""")


def split_csv() -> str:
    """The exports hold the documents, so reading them gives the documents back."""
    cell = ("select concat(source, '-', cast(doc_id % 4 as varchar)) as client_name, cast(doc_id as varchar) as respondent_id, "
            "{i} as col_ord, '{header}' as header, nullif({value}, '') as value from documents")
    cells = " union all ".join(cell.format(i=i, header=h, value=v) for i, (h, v) in enumerate((
        ("Respondent ID", "cast(doc_id as varchar)"), ("Visit Comments", "text"), ("Visit Language", "lang"))))
    return (f"select client_name, respondent_id, col_ord, header, cast(length(value) as integer) as n_chars, sha256(value) as value_sha256 "
            f"from ({cells})")


def queries() -> dict[str, str]:
    return {
        "ingest_words": ingest_words(),
        "split_csv": split_csv(),
        "column_types": column_types(),
        "typed_load": typed_load(),
        "likert_by_file": likert_by_file(),
        "recommendation": recommendation(),
        "speed": speed(),
        "gender": gender(),
        "staff_binary": staff_binary(),
        "likert_columns": likert_columns(),
        "likert": likert(),
        "value_counts": value_counts(),
        "nan_to_null": nan_to_null(),
        "spend": spend(),
        "arrival_time": arrival_time(),
        "parse_dates": parse_dates(),
        "guests": guests(),
        "path_columns": path_columns(),
        "flatten_header": flatten_header(),
        "drop_footer": drop_footer(),
        "clean_identifier": clean_identifier_q(),
        "unique_identifiers": unique_identifiers(),
        "table_profile": table_profile(),
        "client_table_profile": client_table_profile(),
        "section_builder": section_builder(),
        "outer_union": outer_union(),
        "client_ids": client_ids(),
    }
