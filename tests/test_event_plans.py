"""Event queries spread over tasks, parse each event once, and compile."""

import re

from stayline.sources import derived
from stayline.streaming import events as E


def _frame(spark):
    return spark.createDataFrame([(1, '{"customerID": "C-1", "tenure": 3, "MonthlyCharges": 20}')], "event_id long, value string")


def test_generated_methods_are_small_enough_for_the_compiler(spark):
    # Java leaves methods of more than 8,000 bytes to its interpreter.
    rows = E.normalize_events(_frame(spark))
    for df in (rows, E.score_events(rows)):
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
        assert sizes and max(sizes) <= 8000


def test_events_are_parsed_once_also_without_their_time(spark):
    scored = E.score_events(E.normalize_events(_frame(spark))).select("event_id", "churn_probability")
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_first_spelling_with_text_counts(spark):
    sent = '{"customerID": "", "customer_id": "C-2", "customerid": "C-3", "tenure": 1, "MonthlyCharges": "", "monthlycharges": 7}'
    row = E.normalize_events(spark.createDataFrame([(sent,), (None,), ("broken",)], "value string")).collect()
    assert (row[0].customerID, row[0].MonthlyCharges, row[0].error) == ("C-2", 7.0, None)
    assert {r.error for r in row[1:]} == {"Invalid data: Missing required fields in event: customerID, tenure, MonthlyCharges"}


def test_small_events_are_not_broadcast_to_the_customers(spark, folder):
    plan = derived.events(spark, folder)._jdf.queryExecution().sparkPlan().toString()
    top = next(line for line in plan.split("\n") if "Join" in line)
    assert "SortMergeJoin" in top
