"""Customer, prediction and event tables derived from order data.

The input tables carry no churn columns, so a customer record is computed from
the account balance, the key and the first order date. Integers decide every
value; a double appears only as one last division.
"""

from pyspark.sql import functions as F

from stayline import schema as S

AS_OF = "DATE '2001-08-01'"


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def customer_base(spark, folder):
    """One row per customer: the 21 customer columns plus k, bp, churn_probability."""
    first_order = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("k"))
        .agg(F.min("o_orderdate").alias("first_order"))
    )
    customer = table(spark, folder, "customer").selectExpr(
        "c_custkey AS k",
        "(c_custkey * 7919) % 10007 AS h",
        "CAST(round((c_acctbal + 1000) * 100) AS BIGINT) % 10000 + 2000 AS mc",
    )
    facts = customer.join(first_order, "k", "left").selectExpr(
        "*",
        f"""coalesce(least(72, greatest(0,
              datediff({AS_OF}, first_order) div 30 - h % 60)), 0) AS months""",
        """CASE WHEN h % 20 < 11 THEN 'Month-to-month'
                WHEN h % 20 < 15 THEN 'One year' ELSE 'Two year' END AS Contract""",
        *[f"(h div {p}) % 2 AS s{i}" for i, p in enumerate([3, 5, 7, 11, 13, 17], 1)],
    )
    counted = facts.selectExpr("*", "s1 + s2 + s3 + s4 + s5 + s6 AS sc")
    scored = counted.selectExpr(
        "*",
        """greatest(200, least(9800,
             CASE Contract WHEN 'Month-to-month' THEN 5500 WHEN 'One year' THEN 2500 ELSE 1000 END
             + 2988 - months * 83 + (mc * 2) div 5 - 2800 - (sc - 3) * 200)) AS bp""",
    )
    services = [
        f"""CASE WHEN sc = 0 THEN 'No internet service'
                 WHEN s{i} = 1 THEN 'Yes' ELSE 'No' END AS {name}"""
        for i, name in enumerate(S.SERVICES, 1)
    ]
    return scored.selectExpr(
        "concat('C-', k) AS customerID", "k", "bp", "mc",
        "CASE WHEN h % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender",
        "CASE WHEN h % 6 = 0 THEN 1 ELSE 0 END AS SeniorCitizen",
        "CASE WHEN (h div 2) % 2 = 0 THEN 'Yes' ELSE 'No' END AS Partner",
        "CASE WHEN h % 3 = 0 THEN 'Yes' ELSE 'No' END AS Dependents",
        "CAST(months AS INT) AS tenure",
        "CASE WHEN h % 10 < 9 THEN 'Yes' ELSE 'No' END AS PhoneService",
        """CASE WHEN h % 10 = 9 THEN 'No phone service'
                WHEN (h div 4) % 2 = 0 THEN 'Yes' ELSE 'No' END AS MultipleLines""",
        """CASE WHEN sc = 0 THEN 'No' WHEN h % 5 < 2 THEN 'DSL'
                ELSE 'Fiber optic' END AS InternetService""",
        *services,
        "Contract",
        "CASE WHEN (h div 8) % 2 = 0 THEN 'Yes' ELSE 'No' END AS PaperlessBilling",
        """CASE h % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
                WHEN 2 THEN 'Bank transfer (automatic)'
                ELSE 'Credit card (automatic)' END AS PaymentMethod""",
        "CAST(mc AS DOUBLE) / 100 AS MonthlyCharges",
        "CASE WHEN months > 0 THEN CAST(mc * months AS DOUBLE) / 100 END AS TotalCharges",
        "CASE WHEN (h * 31) % 10000 < bp THEN 'Yes' ELSE 'No' END AS Churn",
        "CAST(bp AS DOUBLE) / 10000 AS churn_probability",
    )


def customers(spark, folder):
    return customer_base(spark, folder).select(S.CUSTOMER_COLUMNS)


def predictions(spark, folder):
    return customer_base(spark, folder).select(S.ID, "churn_probability")


def raw_customers(spark, folder):
    """The customer table as it arrives: padded ids, blank charges, some ids missing."""
    return customer_base(spark, folder).withColumns(
        {
            S.ID: F.expr("CASE WHEN k % 97 <> 0 THEN concat(' ', customerID, ' ') END"),
            "TotalCharges": F.expr("coalesce(format_number(TotalCharges, '0.00'), ' ')"),
        }
    ).select(S.CUSTOMER_COLUMNS)


def snapshots(spark, folder):
    """Three growing daily snapshots, told apart by snapshot_ts."""
    return (
        customer_base(spark, folder)
        .withColumn("day", F.explode(F.expr("sequence(CAST(k % 3 AS INT), 2)")))
        .select(
            *S.CUSTOMER_COLUMNS,
            F.format_string("2024010%dT000000Z", F.col("day") + 1).alias("snapshot_ts"),
        )
    )


def drift_sides(spark, folder):
    """(reference, current): even and odd customers, current charges ten percent up."""
    base = customer_base(spark, folder)
    columns = [*S.CUSTOMER_COLUMNS, "churn_probability"]
    current = base.where("k % 2 = 1").withColumn(
        "MonthlyCharges", F.expr("CAST(mc * 11 AS DOUBLE) / 1000")
    )
    return base.where("k % 2 = 0").select(columns), current.select(columns)


def customer_years(spark, folder):
    """One row per customer and year with an order; the history behind KPI trends."""
    years = (
        table(spark, folder, "orders")
        .select(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("year"))
        .distinct()
    )
    return customer_base(spark, folder).join(years, "k")


def model_scores(spark, folder):
    """Scores of three models over the same customers, in long form."""
    base = customer_base(spark, folder).selectExpr(
        "customerID", "k", "CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS label",
        """stack(3, 'scorecard', churn_probability,
                    'tenure_rule', CAST(72 - tenure AS DOUBLE) / 72,
                    'charge_rule', MonthlyCharges / 120) AS (model, score)""",
    )
    return base


def events(spark, folder):
    """Customer events as JSON text: camelCase for even ids, snake_case for odd ones.

    Every fiftieth event lacks its tenure and the one after it names an unknown gender. The
    charges differ between the events of a customer.
    """
    base = customer_base(spark, folder)
    happened = table(spark, folder, "events").select(
        "event_id", "ts", F.col("user_id").alias("k")
    )
    gender = F.expr("CASE WHEN event_id % 50 = 1 THEN 'X' ELSE gender END")
    tenure = F.expr("CASE WHEN event_id % 50 <> 0 THEN tenure END")
    fields = [c for c in S.CUSTOMER_COLUMNS if c != S.TARGET]
    charges = F.expr("CAST(mc + event_id % 7 * 100 AS DOUBLE) / 100")
    values = {"gender": gender, "tenure": tenure, "MonthlyCharges": charges}
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")

    def payload(name_of):
        parts = [values.get(c, F.col(c)).alias(name_of(c)) for c in fields]
        return F.to_json(F.struct(*parts, stamp.alias("timestamp")))

    from stayline.streaming.events import snake_case

    # A broadcast of the events would leave all of them to the few tasks that hold the customers.
    return happened.join(base.hint("merge"), "k").select(
        "event_id",
        "ts",
        F.when(F.col("event_id") % 2 == 0, payload(lambda c: c))
        .otherwise(payload(snake_case))
        .alias("value"),
    )


def dirty_customers(spark, folder):
    """The customer table with one kind of damage per prime divisor of the key."""
    base = customer_base(spark, folder)
    return base.withColumns(
        {
            S.ID: F.expr(
                """CASE WHEN k % 101 = 0 THEN NULL WHEN k % 103 = 0 THEN 'bad id!'
                        ELSE customerID END"""
            ),
            "Churn": F.expr("CASE WHEN k % 109 = 0 THEN 'Maybe' ELSE Churn END"),
            "MonthlyCharges": F.expr("CASE WHEN k % 113 = 0 THEN 250.0D ELSE MonthlyCharges END"),
            "tenure": F.expr(
                "CASE WHEN k % 127 = 0 THEN 101 WHEN k % 137 = 0 THEN -1 ELSE tenure END"
            ),
            "gender": F.expr("CASE WHEN k % 131 = 0 THEN 'X' ELSE gender END"),
            "SeniorCitizen": F.expr("CASE WHEN k % 139 = 0 THEN 2 ELSE SeniorCitizen END"),
            "Contract": F.expr("CASE WHEN k % 149 <> 0 THEN Contract END"),
            "_copies": F.expr("sequence(1, CASE WHEN k % 107 = 0 THEN 2 ELSE 1 END)"),
        }
    ).withColumn("_copies", F.explode("_copies")).select(S.CUSTOMER_COLUMNS)
