"""visitlens: survey and site-visit analytics as Spark DataFrame plans.

Layers:
  sources/    survey files and star-table projections -> DataFrames
  functions/  pure Column expressions (text cleaning, recoders, dates)
  operators/  reusable DataFrame operators (headers, unpivot, ranking, scoring)
  plans/      the report views and the master build, composed from operators
  sinks/      table / parquet / JDBC writers
  llm/        training-data operators (optional, nothing here imports it)

Typical use::

    from visitlens.session import get_spark
    from visitlens.plans.build import build_masters
    from visitlens.plans import views
    from visitlens.sinks.writers import write_each_client

    spark = get_spark()
    m = build_masters(spark, "/data/surveys")          # root/<client>/<venue>.xlsx
    write_each_client(m.each(), "/warehouse/masters")
    views.register_views(spark, section_scores, feedback, m.masters)
    spark.table("vw_report_base_powerbi").show()

``section_scores`` holds the four sections' category and total scores per
visit (one wide frame, or ``{section: frame}``); ``scoring.build_section_scores``
derives it from recoded Likert answers.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions of this package travel to Python workers by value, so executors
# need no copy of it on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
