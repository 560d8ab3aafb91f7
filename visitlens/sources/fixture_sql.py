"""The survey-shaped projections as portable SQL (DuckDB and Spark SQL).

These are the same rules as ``fixtures.py``; the oracle queries use them as
CTEs. ``with_fixtures`` prefixes a query with the CTEs it references.
"""

from __future__ import annotations

import re

FX_VISIT = """
fx_visit as (
select o.o_orderkey as respondent_id,
  concat('client_', lower(r.r_name)) as client_name,
  case when o.o_orderkey % 97 = 0 then concat(n.n_name,' Report')
       when o.o_orderkey % 89 = 0 then concat('iShop ', n.n_name)
       when o.o_orderkey % 83 = 0 then concat(n.n_name,' iSales')
       when o.o_orderkey % 4 = 0 then concat(n.n_name,' (1)')
       when o.o_orderkey % 4 = 1 then concat(n.n_name,' (12)')
       else n.n_name end as venue_name,
  concat(cast(o.o_custkey % 50 as varchar), '.0') as assessor_id,
  o.o_orderpriority as visit_type,
  case when o.o_orderkey % 101 = 0 then concat(lpad(cast(month(o.o_orderdate) as varchar),2,'0'),'/',lpad(cast(day(o.o_orderdate) as varchar),2,'0'),'/0018')
       when o.o_orderkey % 103 = 0 then concat(cast(year(o.o_orderdate)+27 as varchar),'-',lpad(cast(month(o.o_orderdate) as varchar),2,'0'),'-',lpad(cast(day(o.o_orderdate) as varchar),2,'0'))
       when o.o_orderkey % 107 = 0 then cast(null as varchar)
       else concat(lpad(cast(day(o.o_orderdate) as varchar),2,'0'),'/',lpad(cast(month(o.o_orderdate) as varchar),2,'0'),'/',cast(year(o.o_orderdate)+27 as varchar)) end as visit_date_raw
from orders o join customer c on o.o_custkey=c.c_custkey join nation n on c.c_nationkey=n.n_nationkey join region r on n.n_regionkey=r.r_regionkey
)"""

VW_SERVICE = """
vw_service_score as (
select v.client_name, v.venue_name, v.respondent_id, v.assessor_id, v.visit_type, v.visit_date_raw,
  max(case when l.l_linenumber=1 then l.l_quantity*2 end) as service_pre_arrival_score,
  max(case when l.l_linenumber=2 then l.l_quantity*2 end) as service_arrival_score,
  max(case when l.l_linenumber=3 then l.l_quantity*2 end) as service_delivery_score,
  max(case when l.l_linenumber=4 then l.l_quantity*2 end) as service_timing_score,
  max(case when l.l_linenumber=5 then l.l_quantity*2 end) as service_departure_score,
  avg(case when l.l_linenumber<=5 then l.l_quantity*2 end) as service_score
from fx_visit v join lineitem l on l.l_orderkey=v.respondent_id
group by v.client_name, v.venue_name, v.respondent_id, v.assessor_id, v.visit_type, v.visit_date_raw
)"""

VW_SELLING = """
vw_selling_score as (
select v.client_name, v.venue_name, v.respondent_id, v.assessor_id, v.visit_type, v.visit_date_raw,
  max(case when l.l_linenumber=1 then cast(round(l.l_discount*100) as int)*10.0E0 end) as selling_written_score,
  max(case when l.l_linenumber=2 then cast(round(l.l_discount*100) as int)*10.0E0 end) as selling_verbal_score,
  max(case when l.l_linenumber=3 then cast(round(l.l_discount*100) as int)*10.0E0 end) as selling_recommendation_score,
  avg(case when l.l_linenumber<=3 then cast(round(l.l_discount*100) as int)*10.0E0 end) as selling_score
from fx_visit v join lineitem l on l.l_orderkey=v.respondent_id
group by v.client_name, v.venue_name, v.respondent_id, v.assessor_id, v.visit_type, v.visit_date_raw
)"""

VW_PRODUCT = """
vw_product_score as (
select v.client_name, v.venue_name, v.respondent_id, v.assessor_id, v.visit_type, v.visit_date_raw,
  max(case when l.l_linenumber=1 then cast(round(l.l_tax*100) as int)*12.5E0 end) as product_food_concept_score,
  max(case when l.l_linenumber=2 then cast(round(l.l_tax*100) as int)*12.5E0 end) as product_food_application_score,
  max(case when l.l_linenumber=3 then cast(round(l.l_tax*100) as int)*12.5E0 end) as product_food_output_score,
  max(case when l.l_linenumber=4 then cast(round(l.l_tax*100) as int)*12.5E0 end) as product_cold_drinks_score,
  max(case when l.l_linenumber=5 then cast(round(l.l_tax*100) as int)*12.5E0 end) as product_wine_score,
  max(case when l.l_linenumber=6 then cast(round(l.l_tax*100) as int)*12.5E0 end) as product_coffee_score,
  avg(case when l.l_linenumber<=6 then cast(round(l.l_tax*100) as int)*12.5E0 end) as product_score
from fx_visit v join lineitem l on l.l_orderkey=v.respondent_id
group by v.client_name, v.venue_name, v.respondent_id, v.assessor_id, v.visit_type, v.visit_date_raw
)"""

VW_ENVIRONMENT = """
vw_environment_score as (
select v.client_name, v.venue_name, v.respondent_id, v.assessor_id, v.visit_type, v.visit_date_raw,
  max(case when l.l_linenumber=1 then 100-l.l_quantity end) as env_bathroom_score,
  max(case when l.l_linenumber=2 then 100-l.l_quantity end) as env_smoking_score,
  max(case when l.l_linenumber=3 then 100-l.l_quantity end) as env_furnishings_score,
  max(case when l.l_linenumber=4 then 100-l.l_quantity end) as env_hygiene_score,
  max(case when l.l_linenumber=5 then 100-l.l_quantity end) as env_ambiance_score,
  avg(case when l.l_linenumber<=5 then 100-l.l_quantity end) as environment_score
from fx_visit v join lineitem l on l.l_orderkey=v.respondent_id
group by v.client_name, v.venue_name, v.respondent_id, v.assessor_id, v.visit_type, v.visit_date_raw
)"""


def _staff_col(offset: int, name: str) -> str:
    x = f"(v.respondent_id + {offset})"
    return (f"case when {x} % 11 = 0 then 'n/a' when {x} % 13 = 0 then '-1' when {x} % 17 = 0 then 'NaN' "
            f"when {x} % 19 = 0 then cast(null as varchar) "
            f"when {x} % 5 = 0 then concat(cast({x} % 4 as varchar), '.0') else cast({x} % 4 as varchar) end as {name}")


_STAFF_NAMES = ["staff_warmth_score", "staff_presentation_score", "staff_grooming_score",
                "staff_attitude_score", "staff_teamwork_score", "staff_clarity_score"]

VW_FEEDBACK = ("""
vw_feedback_service_all as (
select v.client_name, v.venue_name, v.respondent_id, v.assessor_id, v.visit_type, v.visit_date_raw,
  """ + ",\n  ".join(_staff_col(7 * i, n) for i, n in enumerate(_STAFF_NAMES)) + """
from fx_visit v
)""")

FX_COMMENT_MASTER = """
fx_comment_master as (
select concat('client_', lang) as client_name,
  concat('Venue ', source, case when doc_id % 3 = 0 then ' (2)' else '' end) as venue_name,
  doc_id as respondent_id,
  case when doc_id % 7 = 0 then ' N/A ' when doc_id % 7 = 1 then '   ' when doc_id % 7 = 2 then cast(null as varchar) else concat('  ', text) end as welcome_comments,
  case when doc_id % 5 = 0 then 'nan' when doc_id % 5 = 1 then 'NONE' else text end as ambiance_comments,
  case when doc_id % 4 = 0 then 'Null' when doc_id % 4 = 1 then 'nothing' else concat(text, ' ') end as farewell_comments,
  n_chars as unmapped_number
from documents
)"""


def _word_col(offset: int, name: str) -> str:
    x = f"(v.respondent_id + {offset}) % 10"
    return (f"case {x} when 0 then '1' when 1 then '1.0' when 2 then 'true' when 3 then 'TRUE' "
            f"when 4 then ' Yes ' when 5 then 'yes' when 6 then 'True' when 7 then '0' when 8 then '' end as {name}")


_WORD_NAMES = [
    "thinking_about_the_staff_please_select_the_words_that_best_desc",
    "thinking_about_the_staff_please_select_the_words_that_best_de_1",
    "please_select_the_words_that_best_describe_the_service_that_you",
    "please_select_the_words_that_best_describe_the_service_that_y_1",
]

FX_WORD_MASTER = ("""
fx_word_master as (
select v.client_name, v.venue_name, v.respondent_id,
  """ + ",\n  ".join(_word_col(i, n) for i, n in enumerate(_WORD_NAMES)) + """
from fx_visit v
)""")

FX_SURVEY_WIDE = """
fx_survey_wide as (
select v.client_name, v.venue_name, v.respondent_id,
  case v.respondent_id % 6 when 0 then 'Poor' when 1 then ' fair ' when 2 then 'GOOD' when 3 then 'Very Good' when 4 then 'N/A' end as q_clean,
  case v.respondent_id % 6 when 0 then 'Poor' when 1 then 'Fair' when 2 then 'Average' else 'Good' end as q_mixed,
  case when v.respondent_id % 2 = 0 then 'n/a' end as q_only_na,
  cast(null as varchar) as q_empty,
  case v.respondent_id % 5 when 0 then 'Very likely' when 1 then 'Quite likely ' when 2 then 'Not very likely' when 3 then 'Unsure' end as q_recommend,
  case v.respondent_id % 6 when 0 then 'Within three minutes' when 1 then 'between three and four minutes' when 2 then ' Between four and five minutes ' when 3 then 'Greater than five minutes' when 4 then 'N/A' else 'ages' end as q_drinks_speed,
  case v.respondent_id % 6 when 0 then 'F' when 1 then ' female' when 2 then 'M' when 3 then 'MALE ' when 4 then 'other' end as q_gender,
  case v.respondent_id % 4 when 0 then 'Adept' when 1 then '' when 2 then '  ' end as staff_word_checkbox,
  case when v.respondent_id % 9 = 0 then cast('NaN' as double) when v.respondent_id % 9 = 1 then cast(null as double) else cast(v.respondent_id % 9 as double) end as q_number
from fx_visit v
)"""

FX_RAW_TEXT = """
fx_raw_text as (
select o_orderkey as respondent_id,
  case o_orderkey % 7 when 0 then concat('$', cast(o_orderkey as varchar), '.50') when 1 then '1.2.3' when 2 then 'AUD 1,250.00' when 3 then '' when 4 then 'n/a' when 5 then '-12' end as total_expenditure,
  case o_orderkey % 8 when 0 then '7pm' when 1 then '7:05 PM' when 2 then '07.30 am' when 3 then '12:00:59 pm' when 4 then '19:30' when 5 then '13pm' when 6 then 'late' end as time_you_arrived,
  case when o_orderkey % 6 = 0 then '31/02/2024' when o_orderkey % 6 = 1 then '5/9/2024' when o_orderkey % 6 = 2 then '2024-09-05' when o_orderkey % 6 = 3 then '05-09-2024' when o_orderkey % 6 = 4 then 'soon' end as date_of_visit,
  case o_orderkey % 8 when 0 then 'Two' when 1 then '4' when 2 then ' twenty-three ' when 3 then 'one hundred and five' when 4 then 'many' when 5 then '2.0' when 6 then 'six guests' end as number_of_guests
from orders
)"""

FX_LOAD = """
fx_load as (
select o_orderkey as respondent_id, concat('client_', cast(o_custkey % 5 as varchar)) as client_name,
  case o_orderkey % 7 when 0 then cast(null as varchar) when 1 then ' N/A ' when 2 then concat(cast(o_orderkey as varchar), '.0') else cast(o_orderkey as varchar) end as visits,
  case o_orderkey % 5 when 0 then concat('-', cast(o_orderkey as varchar), '.25') when 1 then '1.5e3' when 2 then '' else cast(o_orderkey as varchar) end as amount,
  case o_orderkey % 4 when 0 then strftime(o_orderdate, '%d/%m/%Y') when 1 then strftime(o_orderdate, '%Y-%m-%d')
    when 2 then concat(' ', strftime(o_orderdate, '%-d-%-m-%Y'), ' ') else 'nan' end as visited,
  case o_orderkey % 3 when 0 then concat(strftime(o_orderdate, '%Y-%m-%d'), ' 07:30:00') when 1 then concat(strftime(o_orderdate, '%Y-%m-%d'), 'T23:05')
    else strftime(o_orderdate, '%d/%m/%Y') end as stamped,
  case o_orderkey % 4 when 0 then 'True' when 1 then ' FALSE' when 2 then 'true' end as flag,
  case when o_orderkey % 4999 = 1 then 'seven' else cast(o_orderkey % 10 as varchar) end as one_bad,
  lpad(cast(o_orderkey % 1000 as varchar), 4, '0') as code,
  concat('9223372036854775', lpad(cast(o_orderkey % 1000 as varchar), 3, '0')) as long_number,
  case o_orderkey % 2 when 0 then 'null' else '  ' end as nothing,
  case o_orderkey % 2 when 0 then '31/02/2024' else '05/09/2024' end as impossible_day
from orders
)"""

FX_FILE = """
fx_file as (
select doc_id as file_id,
  concat('/data/client_', lang, '/', upper(source), '_', cast(doc_id as varchar),
         case doc_id % 4 when 0 then '_iGUEST-Survey v2.1' when 1 then ' Survey V3 (1)' when 2 then '--iguest__survey' else '' end,
         '.xlsx') as path
from documents
)"""

FX_HEADER = """
fx_header_cells as (
select doc_id as file_id,
  list_concat(string_split(text, chr(10)),
              case when doc_id % 2 = 0 then ['IMPORTANT: check for typos before you submit'] else []::varchar[] end) as cells
from documents
),
fx_header_pos as (
select file_id, cells, unnest(range(len(cells))) as i from fx_header_cells
),
fx_header as (
select file_id, cast(i as integer) as col_ord, cells[i + 1] as header_top,
  case when i = 0 then 'Unnamed: 0_level_1'
       when length(cells[i + 1]) % 3 = 0 then 'Comments'
       when length(cells[i + 1]) % 3 = 1 then 'Response'
       else concat('Unnamed: ', cast(i as varchar), '_level_1') end as header_sub
from fx_header_pos
)"""

# name -> (definition, dependencies)
FIXTURES = {
    "fx_visit": (FX_VISIT, []),
    "vw_service_score": (VW_SERVICE, ["fx_visit"]),
    "vw_selling_score": (VW_SELLING, ["fx_visit"]),
    "vw_product_score": (VW_PRODUCT, ["fx_visit"]),
    "vw_environment_score": (VW_ENVIRONMENT, ["fx_visit"]),
    "vw_feedback_service_all": (VW_FEEDBACK, ["fx_visit"]),
    "fx_comment_master": (FX_COMMENT_MASTER, []),
    "fx_word_master": (FX_WORD_MASTER, ["fx_visit"]),
    "fx_survey_wide": (FX_SURVEY_WIDE, ["fx_visit"]),
    "fx_raw_text": (FX_RAW_TEXT, []),
    "fx_load": (FX_LOAD, []),
    "fx_file": (FX_FILE, []),
    "fx_header": (FX_HEADER, []),
}


def with_fixtures(query: str, extra_ctes: str = "") -> str:
    """Prefix ``query`` with the fixture CTEs it names (and their dependencies)."""
    needed: list[str] = []

    def add(name):
        if name in needed:
            return
        for dep in FIXTURES[name][1]:
            add(dep)
        needed.append(name)

    text = query + extra_ctes
    for name in FIXTURES:
        if re.search(rf"\b{name}\b", text):
            add(name)
    ctes = [FIXTURES[n][0].strip() for n in needed]
    if extra_ctes:
        ctes.append(extra_ctes.strip())
    if not ctes:
        return query
    return "with " + ",\n".join(ctes) + "\n" + query
