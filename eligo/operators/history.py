"""Per-person history features, computed on a reduced table.

Every history feature of a charge depends only on its person, its hearing day
and its category triple (charge, disposition, code-section category). So the
charge rows are first reduced to one row per
``(person, hearing day, category triple)`` with a plain ``groupBy``; Spark
combines map-side, so a person or day holding a huge share of all rows
collapses before the shuffle. The person windows then run on that reduced
table, where a person has at most ``distinct days x 24`` rows no matter how
many charges they hold, and the result joins back to the charge rows once.

Null person ids are not one giant person: each such charge is its own person
(``_pnull`` true, ``_pid`` the charge id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eligo import constants as K
from eligo.functions.categories import is_conviction, is_felony_conviction
from eligo.functions.dates import day_number, from_day_number

PERSON_KEYS = ("_pid", "_pnull")
COMBO_KEYS = ("charge_category", "disposition_category", "code_section_category")
# The category triple travels through shuffles as small integer codes (1-based positions in these domains).
CATEGORY_DOMAINS = {
    "charge_category": (K.MISDEMEANOR, K.FELONY),
    "disposition_category": (K.CONVICTION, K.DISMISSED, K.DEFERRAL),
    "code_section_category": (K.CS_A, K.CS_B, K.CS_12, K.CS_ELSEWHERE, K.CS_12_D1),
}
CODE_KEYS = ("_cc", "_dc", "_csc")
DAY_KEYS = PERSON_KEYS + ("hearing_date",)
GROUP_KEYS = DAY_KEYS + CODE_KEYS


def with_person_key(df: DataFrame, person_col: str = "person_id", id_col: str = "id") -> DataFrame:
    """Add the non-null person key used by every window and join here."""
    return df.withColumns({
        "_pnull": F.col(person_col).isNull(),
        "_pid": F.coalesce(F.col(person_col), F.col(id_col)),
    })


def with_category_codes(rows: DataFrame) -> DataFrame:
    """Add the integer codes of the category triple (the grouping and join keys)."""
    return rows.withColumns({
        code: F.array_position(F.array(*[F.lit(v) for v in CATEGORY_DOMAINS[name]]), F.col(name)).cast("byte")
        for code, name in zip(CODE_KEYS, COMBO_KEYS)})


def decode_categories(groups: DataFrame) -> DataFrame:
    """Category text back from the codes (once per group row)."""
    return groups.withColumns({
        name: F.element_at(F.array(*[F.lit(v) for v in CATEGORY_DOMAINS[name]]), F.col(code).cast("int"))
        for code, name in zip(CODE_KEYS, COMBO_KEYS) if code in groups.columns})


def person_window():
    """Whole-person frame, ordered by day only so that it shares one sort with the day-ordered windows."""
    return (Window.partitionBy(*PERSON_KEYS).orderBy("_day")
            .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def day_ordered():
    return Window.partitionBy(*PERSON_KEYS).orderBy("_day")


def days_before(lo=None):
    """Frame of strictly earlier days (optionally no more than ``lo`` days back)."""
    start = Window.unboundedPreceding if lo is None else -lo
    return day_ordered().rangeBetween(start, -1)


def days_after(hi=None):
    """Frame of strictly later days (optionally no more than ``hi`` days ahead)."""
    end = Window.unboundedFollowing if hi is None else hi
    return day_ordered().rangeBetween(1, end)


def same_day():
    return Window.partitionBy(*PERSON_KEYS, "_day")


def _flag_or_false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def reduce_to_groups(rows: DataFrame, keys=GROUP_KEYS) -> DataFrame:
    """One row per (person, day, categories) with the row count and class flags.

    Partial aggregation happens before the exchange, so the shuffle carries at
    most one row per group per map task.
    """
    conv_fel = is_felony_conviction()
    felony = F.coalesce(F.col("charge_category") == F.lit("Felony"), F.lit(False))
    c12 = F.col("charge_class").isin("1", "2")
    c34 = F.col("charge_class").isin("3", "4")
    aggs = {
        "_n": F.count(F.lit(1)),
        "_c12": F.bool_or(_flag_or_false(conv_fel & c12)),
        "_c34": F.bool_or(_flag_or_false(conv_fel & c34)),
        "_c12_any": F.bool_or(_flag_or_false(felony & c12)),
        "_c34_any": F.bool_or(_flag_or_false(felony & c34)),
    }
    grouped = rows.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggs.items()])
    return decode_categories(grouped).withColumn("_day", day_number("hearing_date"))


def history_columns(groups: DataFrame, cutoff: str) -> DataFrame:
    """Date features of the canonical rules, on the reduced table.

    * ``has_conviction``: any conviction of the person (the row itself included);
    * ``last_hearing_date``: latest hearing on a strictly earlier day;
    * ``last_felony_conviction_date``: latest felony conviction on a strictly earlier day;
    * ``next_conviction_date``: earliest conviction on a strictly later day;
    * the four day gaps (``from_present_delta`` = cutoff - hearing date);
    * class flags: any felony conviction of class 1/2 (3/4) of the person.
    """
    conv = is_conviction()
    fel_conv = is_felony_conviction()
    cutoff_col = F.lit(cutoff).cast("date")
    return (groups
            .withColumns({
                "has_conviction": F.bool_or(conv).over(person_window()),
                "has_class_1_or_2": F.bool_or("_c12").over(person_window()),
                "has_class_3_or_4": F.bool_or("_c34").over(person_window()),
                "_any_c12": F.bool_or("_c12_any").over(person_window()),
                "_any_c34": F.bool_or("_c34_any").over(person_window()),
                "_last_day": F.max("_day").over(days_before()),
                "_last_fel_day": F.max(F.when(fel_conv, F.col("_day"))).over(days_before()),
                "_next_conv_day": F.min(F.when(conv, F.col("_day"))).over(days_after()),
                "_day_rows": F.sum("_n").over(same_day()),
            })
            .withColumns({
                "last_hearing_date": from_day_number("_last_day"),
                "last_felony_conviction_date": from_day_number("_last_fel_day"),
                "next_conviction_date": from_day_number("_next_conv_day"),
                "last_hearing_delta": (F.col("_day") - F.col("_last_day")).cast("int"),
                "last_felony_conviction_delta": (F.col("_day") - F.col("_last_fel_day")).cast("int"),
                "next_conviction_delta": (F.col("_next_conv_day") - F.col("_day")).cast("int"),
                "from_present_delta": F.datediff(cutoff_col, F.col("hearing_date")),
            }))


def smallest_ids(rows: DataFrame, k: int, keys=GROUP_KEYS) -> DataFrame:
    """Per (person, day, categories): the ``k`` smallest charge ids, as a sorted array.

    ``row_number() <= k`` is planned as a partial ``WindowGroupLimit`` before
    the exchange, so a hot group ships at most ``k`` ids per map task.
    """
    ranked = (rows.select(*keys, "id")
              .withColumn("_rk", F.row_number().over(Window.partitionBy(*keys).orderBy("id")))
              .filter(F.col("_rk") <= k))
    return ranked.groupBy(*keys).agg(F.array_sort(F.collect_list("id")).alias("_ids"))


def kth_counted_id_of_day(counted: Column, need: Column) -> Column:
    """The ``need``-th smallest id among counted charges of the same person and day.

    The running count of the lifetime rule orders a person's charges by
    (hearing date, id); counts of earlier days come from a day-ordered window,
    and inside the day only the first few counted ids matter. Each group
    carries its smallest ids, so the day holds at most 24 * k candidates.
    """
    day_ids = F.array_sort(F.flatten(F.collect_list(F.when(counted, F.col("_ids"))).over(same_day())))
    return F.when(need >= 1, F.try_element_at(day_ids, need.cast("int")))
