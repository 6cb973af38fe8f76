from __future__ import annotations

import datetime
import random
from collections import defaultdict

from pyspark.sql import functions as F

from finledger.operators import audit, coverage
from finledger.sources import tables

SCHEMA = "TIPO string, NOME string, CNPJ_CIA string, DT_REFER date"


def plain(rows):
    companies, filings = defaultdict(set), defaultdict(set)
    for kind, name, company, date in rows:
        if company is not None and date is not None:
            companies[kind, name].add(company)
            filings[kind, name].add((company, date))
    return {k: (len(companies[k]), len(filings[k])) for k in companies}


def counts(df):
    return {(r["TIPO"], r["NOME"]): (r["EMPRESAS"], r["FILINGS"]) for r in df.collect()}


def noise(seed, years, n=3000):
    rng = random.Random(seed)
    rows = [
        (rng.choice("VG"), rng.choice(["a", "b", None]), rng.choice([f"{rng.randrange(90):014d}", None]),
         datetime.date(rng.choice(years), rng.choice([3, 12]), 31))
        for _ in range(n)
    ]
    return rows + rows[:50] + [("V", "a", "1", None)]


def test_counts_are_exact_and_merge(spark, tmp_path):
    path, first, late = str(tmp_path / "c"), noise(1, [2010, 2011]), noise(2, [2012])
    rows = [r for r in first + late if r[3] is not None]
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    coverage.keep(frame(first), path)
    assert counts(coverage.kept_counts(spark, path)) == plain(first)
    before = set(tables.parts(spark, f"{path}/presenca"))
    coverage.refresh(frame([r for r in late if r[3] is not None]), [2012], path)
    assert counts(coverage.kept_counts(spark, path)) == plain(rows)
    assert before < set(tables.parts(spark, f"{path}/presenca"))  # the earlier years' files are the same
    corrected = [(a, b, "99999999999999", d) for a, b, _, d in late[:40] if d is not None]
    coverage.refresh(frame(corrected), [2012], path)
    assert counts(coverage.kept_counts(spark, path)) == plain([r for r in rows if r[3].year != 2012] + corrected)
    coverage.refresh(frame([]), [2010, 2012], path)
    assert counts(coverage.kept_counts(spark, path)) == plain([r for r in rows if r[3].year == 2011])


def test_many_companies_span_bitmaps(spark):
    facts = spark.range(70000).select(
        F.lit("V").alias("TIPO"), F.lit("a").alias("NOME"), F.col("id").cast("string").alias("CNPJ_CIA"),
        F.make_date(F.lit(2010) + (F.col("id") % 2).cast("int"), F.lit(1), F.lit(1)).alias("DT_REFER"),
    )
    numbers = coverage.company_numbers(spark.createDataFrame([("5", 1)], coverage.NUMBERS), facts)
    assert numbers.agg(F.count("*"), F.count_distinct("NUMERO"), F.max("NUMERO")).first()[:] == (70000, 70000, 70000)
    maps = coverage.presence(facts.union(facts), numbers)
    assert maps.select("BALDE").distinct().count() == 3
    assert counts(coverage.distinct_counts(maps)) == {("V", "a"): (70000, 70000)}
    plan = maps._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_same_report_as_distinct_counts(spark, data_dir):
    from finledger.plans import lake

    stacked = lake.repaired_accounts(spark, data_dir)
    facts = audit.coverage_facts(stacked)
    numbers = coverage.company_numbers(spark.createDataFrame([], coverage.NUMBERS), facts)
    found = audit.coverage_from_counts(coverage.distinct_counts(coverage.presence(facts, numbers)))
    assert sorted(map(repr, found.collect())) == sorted(map(repr, audit.variable_coverage(stacked).collect()))
