"""Account-tree operators: bottom-up repair, leaves of the repaired table, level labels, parent-child check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finledger.functions.expressions import ancestors, digits, is_close, parent_code, segments
from finledger.operators.rows import newest_first, newest_row

FILING = ["CNPJ_CIA", "DT_REFER"]
TINY = 0.01
# Lines that a task repairs: it sorts them once for every level, so its memory is some hundred MB.
LINES_PER_TASK = 200_000


def collapse_accounts(df: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per entity, date and account; values of duplicates are added.

    The sum combines on the map side. ``carry`` names further aggregates to take along in the same shuffle.
    """
    extra = [c.alias(name) for name, c in (carry or {}).items()]
    return df.groupBy(*FILING, "CD_CONTA", "CD_CONTA_QTD_DIGITOS").agg(
        F.sum("VL_CONTA_TRATADO").alias("VL_CONTA_TRATADO"), F.min("DENOM_CIA").alias("DENOM_CIA"), *extra
    )


def deepest_level(lines: DataFrame) -> int:
    """Segments of the longest account code: one column of the table is read."""
    return lines.select(F.max(segments("CD_CONTA"))).first()[0] or 0


def tree_size(lines: DataFrame) -> tuple[int, int]:
    """Segments of the longest account code, and the number of lines: one column of the table is read."""
    deepest, rows = lines.select(F.max(segments("CD_CONTA")), F.count("*")).first()
    return deepest or 0, rows


def by_filing(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` shuffled by filing, in as many parts as its number of ``rows`` (or a bound on it) asks for.

    Adaptive execution cuts parts by their bytes in the shuffle, of which a repair needs many times as much memory. It is
    left to it where the cores alone make the parts small, or where the number is unknown.
    """
    spark = df.sparkSession
    # Branches of a union share the cores, so a part may be a few times a core's share.
    if rows is None or rows <= LINES_PER_TASK * max(1, spark.sparkContext.defaultParallelism // 2):
        return df.repartition(*FILING)
    # Not fewer parts than other shuffles have: a join by filing then keeps to these.
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // LINES_PER_TASK)), *FILING)


def roll_up(
    collapsed: DataFrame,
    rule: str,
    lowest_child_level: int,
    deepest: int | None = None,
    carry: list[str] | None = None,
    placed: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """Rebuild parents from their children, deepest level first.

    ``rule='safe'`` fills a parent only where it is (almost) zero and its children are not; ``rule='force'`` takes the
    children's sum whenever it is not zero and differs. Missing parents are inserted under both. Children above
    ``lowest_child_level`` (2 for trees with a root account, 3 for trees without) build no parent.

    Every depth that occurs is rolled up. ``deepest`` is a bound on it that the caller knows from a cheaper table;
    without one the input is asked. The same holds for ``rows``, a bound on the lines, which sets the number of tasks.

    ``ACAO`` tells what happened: kept, protected (kept though the children disagree), filled, forced or inserted.

    The input has one row per account, so a filing is bounded by the chart of accounts. It is shuffled once by
    filing; every possible parent is added as an empty row, and each level is then a window inside the filing, in an order
    that all levels share: no join, one sort, and no further shuffle, whatever the number of levels. An input that is
    ``placed`` comes from a table stored by filing and is not shuffled at all.
    """
    carry = carry or []
    above = F.filter(ancestors("CD_CONTA"), lambda a: F.size(F.split(a, r"\.")) >= lowest_child_level - 1)
    if deepest is None:
        deepest, rows = tree_size(collapsed)
    grouped = collapsed if placed else by_filing(collapsed, rows)
    spread = grouped.withColumn("_code", F.explode(F.concat(F.array("CD_CONTA"), above)))
    own = F.col("_code") == F.col("CD_CONTA")
    # One reported row per account at most, so the aggregates below pick it; an account without one stays empty.
    tree = spread.groupBy(*FILING, F.col("_code").alias("_account")).agg(
        F.max(F.when(own, F.col("VL_CONTA_TRATADO"))).alias("VL_CONTA_TRATADO"),
        F.coalesce(F.min(F.when(own, F.col("DENOM_CIA"))), F.min("DENOM_CIA")).alias("DENOM_CIA"),
        F.bool_or(own).alias("_orig"),
        *[F.first(F.when(own, F.col(c)), ignorenulls=True).alias(c) for c in carry],
    )
    tree = tree.withColumnRenamed("_account", "CD_CONTA").withColumns(
        {
            "CD_CONTA_QTD_DIGITOS": digits("CD_CONTA"),
            "VL_CONTA_TRATADO": F.col("VL_CONTA_TRATADO").cast("decimal(38,6)"),
            "_level": segments("CD_CONTA"),
            "ACAO": F.when(F.col("_orig"), "kept").otherwise("inserted"),
        }
    )
    value = F.col("VL_CONTA_TRATADO")
    # From the last code to the first, the accounts below one come right before it, as the part mark sorts before all else.
    # All levels share this one order, so a filing is sorted once.
    tree = tree.withColumn("_path", F.replace("CD_CONTA", F.lit("."), F.lit("\0")))
    filing = Window.partitionBy(*FILING).orderBy(F.col("_path").desc())
    so_far, before = filing.rowsBetween(Window.unboundedPreceding, 0), filing.rowsBetween(Window.unboundedPreceding, -1)
    for child in range(deepest, lowest_child_level - 1, -1):
        is_child, is_parent = F.col("_level") == child, F.col("_level") == child - 1
        total, number = F.col("_run.total"), F.col("_run.number")
        calc = F.col("_calc")
        if rule == "safe":
            replace = (F.abs(value) < TINY) & (F.abs(calc) > TINY)
            protect = (F.abs(value) > TINY) & ~is_close(calc, value)
            action = "filled"
        else:
            replace = (calc != 0) & ~is_close(calc, value)
            protect = F.lit(False)
            action = "forced"
        known = is_parent & calc.isNotNull()
        # A code that ends in a dot names no account below another.
        seen = F.when(is_child & ~F.col("CD_CONTA").endswith("."), value)
        # What was counted up to the account itself, less what was counted up to the last one that is not below it.
        run = F.struct(
            F.coalesce(F.sum(seen).over(so_far), F.lit(0)).cast("decimal(38,6)").alias("total"),
            F.count(seen).over(so_far).alias("number"),
        )
        outside = F.last(F.when(F.col("_level") < child, F.col("_run")), ignorenulls=True).over(before)
        own = (total - F.coalesce(F.col("_outside.total"), F.lit(0).cast("decimal(38,6)"))).cast("decimal(38,6)")
        tree = (
            tree.withColumn("_run", run)
            .withColumn("_outside", outside)
            .withColumn("_calc", F.when(is_parent & (number > F.coalesce("_outside.number", F.lit(0))), own))
            .withColumns(
                {
                    "ACAO": F.when(known & F.col("_orig") & replace, action)
                    .when(known & F.col("_orig") & protect, "protected")
                    .otherwise(F.col("ACAO")),
                    "VL_CONTA_TRATADO": F.when(known & (~F.col("_orig") | replace), calc)
                    .otherwise(value)
                    .cast("decimal(38,6)"),
                }
            )
            .drop("_run", "_outside", "_calc")
        )
    return tree.filter(value.isNotNull()).drop("_orig", "_level", "_path")


def repair_counts(repaired: DataFrame) -> DataFrame:
    """Gaps that were filled and reported values that were kept against their children."""
    return repaired.agg(
        F.count("*").alias("LINHAS"),
        F.count_if(F.col("ACAO").isin("filled", "forced", "inserted")).alias("RECONSTRUIDAS"),
        F.count_if(F.col("ACAO") == "inserted").alias("INSERIDAS"),
        F.count_if(F.col("ACAO") == "protected").alias("PROTEGIDAS"),
    )


def mark_global_leaves(df: DataFrame, scope: str = "table") -> DataFrame:
    """``IS_LEAF``: the code is nobody's parent anywhere in the table. A root is its own parent, so never a leaf.

    ``scope='entity'`` looks only inside the company. The parents are distinct codes (or company codes), reduced on
    the map side before the join.
    """
    keys = ["CD_CONTA"] if scope == "table" else ["CNPJ_CIA", "CD_CONTA"]
    parents = (
        df.withColumn("CD_CONTA", parent_code("CD_CONTA")).select(*keys).distinct().withColumn("_parent", F.lit(True))
    )
    return df.join(parents, keys, "left").withColumn("IS_LEAF", F.col("_parent").isNull()).drop("_parent")


def level_labels(codes: DataFrame, names: DataFrame, levels: int = 5, root: str | None = None) -> DataFrame:
    """``DS_NIVEL_1..n`` per account code: canonical name of the code's prefix at each level.

    Works on one row per code, so that the ledger itself needs a single join. A taxonomy without a reported root
    gets a constant first level.
    """
    prefixes = codes.select(
        "CD_CONTA", F.posexplode(F.concat(ancestors("CD_CONTA"), F.array("CD_CONTA"))).alias("_pos", "_prefix")
    )
    lookup = names.select(F.col("CD_CONTA").alias("_prefix"), F.col("DS_CONTA").alias("_name"))
    labels = prefixes.join(lookup, "_prefix", "left").groupBy("CD_CONTA").agg(
        *[F.max(F.when(F.col("_pos") == i, F.col("_name"))).alias(f"DS_NIVEL_{i + 1}") for i in range(levels)]
    )
    return labels if root is None else labels.withColumn("DS_NIVEL_1", F.lit(root))


def level_names_by_filing(lines: DataFrame, levels: int = 5) -> DataFrame:
    """Reported name of every account's prefix in its own filing, newest version first.

    The prefixes of each distinct account are exploded and matched once, then folded back into one row.
    """
    keys = ["CNPJ_CIA", "DT_REFER", "GRUPO_DFP_TRATADO"]
    reported = newest_row(lines, [*keys, "CD_CONTA"], newest_first("VERSAO", "LINE_ID", "LINE_SEQ", "VL_CONTA")).select(
        *keys, F.col("CD_CONTA").alias("_prefix"), F.upper(F.trim("DS_CONTA")).alias("_name")
    )
    accounts = lines.select(*keys, "CD_CONTA").distinct()
    prefixes = accounts.select(
        *keys, "CD_CONTA", F.posexplode(F.concat(ancestors("CD_CONTA"), F.array("CD_CONTA"))).alias("_pos", "_prefix")
    )
    matched = prefixes.join(reported, [*keys, "_prefix"], "left")
    return matched.groupBy(*keys, "CD_CONTA").agg(
        *[F.max(F.when(F.col("_pos") == i, F.col("_name"))).alias(f"DS_NIVEL_{i + 1}") for i in range(levels)]
    )


def parent_child_pairs(df: DataFrame) -> DataFrame:
    """Each parent with the sum of its direct children, by equality on the derived parent code."""
    child_sum = (
        df.filter(segments("CD_CONTA") > 1)
        .groupBy(*FILING, parent_code("CD_CONTA").alias("CD_CONTA"))
        .agg(F.sum("VL_CONTA_TRATADO").alias("SOMA_FILHOS"))
    )
    return df.join(child_sum, [*FILING, "CD_CONTA"])


def pair_status(parent: Column, children: Column, tolerance: float = 1000.0) -> Column:
    return (
        F.when(F.abs(parent - children) <= tolerance, "OK")
        .when((parent == 0) & (children == 0), "ZERADO")
        .otherwise("DESBALANCEADO")
    )
