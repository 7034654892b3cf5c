"""Booking tables derived from the benchmark star schema (see FIXTURES.md).

Every row of lineitem becomes a reservation, every row of part a table of a
shift template, every row of supplier a date override; five suppliers make a
venue. The oracle module holds the same rules once more, in its own dialect.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

AS_OF = dt.date(2001, 1, 1)
NOW = dt.datetime(2001, 1, 1, 12, 0)

_SHIFT = "element_at(array('lunch', 'brunch', 'dinner'), cast({0} as int) + 1)"
_START = "element_at(array(660, 600, 1080), cast({0} as int) + 1)"
_END = "element_at(array(900, 870, 60), cast({0} as int) + 1)"
_CLOCK = "timestamp_ntz'1900-01-01 00:00:00' + interval '1' minute * {0}"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores: a file of few megabytes is one task, and the documents derived from its rows are long."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _finished(df: DataFrame, **columns: str) -> DataFrame:
    """Select SQL expressions as finished columns.

    The one-row generator keeps later filters and expressions from getting
    copies of these (long) expressions inlined; they read plain columns, as
    they would from a file.
    """
    fields = ", ".join(f"'{name}', {text}" for name, text in columns.items())
    return df.selectExpr(f"inline(array(named_struct({fields})))")


def _turns(base: str, with_nine: bool = True) -> str:
    """SQL text of a party-size -> minutes object growing from ``base``."""
    parts = [("2", 0), ("4", 30), ("6", 45), ("8", 60)] + ([("9", 75)] if with_nine else [])
    body = " || ',' || ".join(f"'\"{size}\":' || ({base} + {extra})" for size, extra in parts)
    return f"'{{' || {body} || '}}'"


def durations_sql(variant: str, base: str) -> str:
    """SQL text (valid in both dialects) of the turn-time document of a table."""
    full, later, short = _turns(base), _turns(f"{base} + 15"), _turns(base, with_nine=False)
    def document(*ranges: tuple[str, str]) -> str:
        body = " || ',' || ".join(f"'\"{clock}\":' || {turns}" for clock, turns in ranges)
        return f"'{{' || {body} || '}}'"

    return (
        f"case when {variant} < 6 then {document(('11:00', full), ('17:00', later))} "
        f"when {variant} < 9 then {document(('11:00', short), ('17:00', short))} "
        f"when {variant} < 11 then {document(('17:00', full), ('10:00', later))} "
        f"when {variant} < 13 then {document(('06:00', full), ('11:00', full), ('12:30', later))} "
        f"when {variant} = 13 then '{{\"18:00\":{{\"2\":0,\"4\":0,\"6\":0,\"8\":0,\"9\":0}}}}' "
        f"when {variant} = 14 then '{{\"10:00\":{{\"2\":75,\"4\":null}}}}' "
        "when venue % 2 = 0 then '{}' else '{broken' end"
    )


# Pacing documents by variant number; 0 is null.
PACING = [
    None,
    '{"660":10,"690":null,"1110":12,"0":1}',
    "{}",
    '{"600":8,"615":8,"630":-1,"645":4,"1080":20,"1140":0,"30":5}',
    '{"660":12,"675":12,"690":12,"705":12}',
    "{broken",
    "{}",
    '{"720":9.5,"1200":15}',
]


def pacing_sql(variant: str) -> str:
    whens = " ".join(f"when {i} then '{text}'" for i, text in enumerate(PACING) if text is not None)
    return f"case {variant} {whens} end"


def reservations(lineitem: DataFrame) -> DataFrame:
    coded = lineitem.selectExpr(
        "l_suppkey div 5 as venue",
        "l_linenumber % 3 as shift",
        "datediff(to_date(l_shipdate), date'1995-01-02') div 7 as week",
        "l_orderkey as o",
        "l_partkey as p",
        "l_linenumber as n",
        "l_returnflag as flag",
        "cast(l_quantity as int) as quantity",
    )
    placed = coded.selectExpr(
        "*",
        "date_add(date'1998-06-01', cast(case o % 50 when 7 then 399 + week % 4 * 7 "
        "when 8 then week % 2 * 7 else 763 + week % 34 * 7 end "
        "+ (venue + shift div 2 + case when o % 3 = 0 then 3 else 0 end) % 7 as int)) as service",
        "case when p % 97 = 1 then 380 when p % 83 = 5 then -1 "
        "when p % 10 = 0 then (p * 7 + n * 3) % 30 + 30 * (o % 5) "
        "else (p * 7 + n * 3) % 30 end as lead",
    )
    return _finished(
        placed,
        venue_key_id="venue",
        shift_persistent_id=_SHIFT.format("shift"),
        marked_time="case when o % 97 <> 0 then cast(service as timestamp_ntz) + interval '1' minute * "
        f"({_START.format('shift')} + (o % 9) * (30 + 30 * (shift div 2))) end",
        date="service",
        created="case when o % 89 <> 0 then cast(date_sub(service, cast(lead as int)) as timestamp_ntz) "
        "+ interval '1' minute * (o % 1440) end",
        status="case when p % 101 <> 0 then case flag when 'R' then 'CANCELED' when 'A' then 'COMPLETE' "
        "else 'CONFIRMED' end end",
        max_guests="case when p % 61 <> 3 and (venue + week % 34) % 23 <> 5 then 1 + quantity % 8 end",
    )


def shift_templates(part: DataFrame) -> DataFrame:
    """One template per (venue, number 0..14): three shifts in five versions."""
    grouped = (
        part.selectExpr("p_partkey div 100 as venue", "(p_partkey % 100) % 15 as t", "p_type")
        .groupBy("venue", "t")
        .agg({"p_type": "min"})
        .withColumnRenamed("min(p_type)", "category")
    )
    placed = grouped.selectExpr(
        "*",
        "t % 3 as shift",
        "t div 3 as version",
        "(venue + (t % 3) div 2) % 7 as wd1",
        "case when venue % 2 = 0 then (venue + (t % 3) div 2 + 3) % 7 end as wd2",
    ).selectExpr(
        "*",
        "element_at(array(date'1999-07-05', date'2000-07-03', date'2000-10-02', date'2000-10-02', "
        "date'1998-06-01'), cast(version as int) + 1) as opens",
        "case version when 0 then date'1999-08-01' when 1 then date'2000-10-01' "
        "when 2 then case when venue % 2 = 0 then date'2001-02-25' end "
        "when 4 then date'1998-06-14' end as closes",
        "transform(sequence(0, 6), i -> i = wd1 or (wd2 is not null and i = wd2)) as mask",
    )
    return placed.selectExpr(
        "venue * 100 + t as int_id",
        "venue as venue_key_id",
        f"{_SHIFT.format('shift')} as persistent_id",
        f"initcap({_SHIFT.format('shift')}) || ' v' || version as name",
        "category",
        "opens as effective_start_date",
        "closes as effective_end_date",
        "case when venue % 10 = 9 then slice(mask, 1, 5) "
        "when venue % 4 = 1 then transform(mask, x -> nullif(x, false)) else mask end as day_of_week",
        "case when venue % 3 = 2 then null "
        "when venue % 3 = 1 then array(date_add(opens, cast(wd1 as int)), null, date_add(opens, cast(wd1 + 21 as int))) "
        "else array(date_add(opens, cast(wd1 as int)), date_add(opens, cast(wd1 + 21 as int))) end as excluded_dates",
        "case when version = 3 and venue % 2 = 0 then timestamp_ntz'2000-11-01 00:00:00' end as archived",
        "case when version = 3 and venue % 2 = 1 then timestamp_ntz'2000-11-01 00:00:00' end as deleted",
    )


def template_tables(part: DataFrame) -> DataFrame:
    """One row per (template, table): every part is a table of one template."""
    placed = _spread(part.select("p_size", "p_partkey")).selectExpr(
        "p_size as size", "p_partkey div 100 as venue", "(p_partkey % 100) % 15 as t"
    ).selectExpr("*", "t % 3 as shift", "t div 3 as version")
    return _finished(
        placed,
        int_id="venue * 100 + t",
        venue_key_id="venue",
        persistent_id=_SHIFT.format("shift"),
        name=f"initcap({_SHIFT.format('shift')}) || ' v' || version",
        interval_minutes="case when t = 12 and venue % 4 = 3 then null "
        "else element_at(array(15, 30, 60), cast((venue + t) % 3 as int) + 1) end",
        deleted="cast(null as timestamp_ntz)",
        start_time=_CLOCK.format(_START.format("shift")),
        end_time=_CLOCK.format(_END.format("shift")),
        effective_start_date="cast(null as date)",
        effective_end_date="cast(null as date)",
        table_size="case when size < 50 then element_at(array(2, 4, 6, 8, 10, 12), size % 6 + 1) end",
        custom_pacing_str=pacing_sql("(venue * 7 + t) % 8"),
        covers_per_seating_interval="case when (venue + t) % 11 <> 10 then cast(2 + (venue + t) % 5 as int) end",
        shift_start_time_min=f"case when t = 13 and venue % 4 = 2 then null else {_START.format('shift')} end",
        shift_end_time_min=_END.format("shift"),
        duration_minutes_by_party_size_str="cast(null as string)",
        duration_dict_ranges_str=durations_sql("(venue * 5 + t * 3) % 16", "(45 + (venue + t) % 40)"),
    )


def overrides(supplier: DataFrame) -> DataFrame:
    placed = supplier.selectExpr("s_suppkey div 5 as venue", "(s_suppkey % 5) % 3 as j")
    return placed.selectExpr(
        "date_add(date'2000-10-05', cast((venue * 11 + j * 17) % 120 as int)) as date",
        "1000000000 + venue * 10 + j as int_id",
        "venue as venue_key_id",
        "case when j = 1 then 'HOLIDAY' else 'EVENT' end as category",
        "case when venue % 7 = 4 and j = 2 then timestamp_ntz'2000-09-01 00:00:00' end as deleted",
    )


def override_tables(supplier: DataFrame) -> DataFrame:
    placed = _spread(supplier.select("s_suppkey")).selectExpr(
        "s_suppkey div 5 as venue", "(s_suppkey % 5) % 3 as j", "explode(array(2, 4, 8, 12)) as size"
    )
    return _finished(
        placed,
        int_id="1000000000 + venue * 10 + j",
        venue_key_id="venue",
        persistent_id=_SHIFT.format("j"),
        name=f"initcap({_SHIFT.format('j')}) || ' special'",
        interval_minutes="element_at(array(15, 30, 60), cast(j as int) + 1)",
        deleted="cast(null as timestamp_ntz)",
        start_time=_CLOCK.format(_START.format("j")),
        end_time=_CLOCK.format(_END.format("j")),
        effective_start_date="cast(null as date)",
        effective_end_date="cast(null as date)",
        table_size="size",
        custom_pacing_str="'{}'",
        covers_per_seating_interval="cast(3 + j as int)",
        shift_start_time_min=_START.format("j"),
        shift_end_time_min=_END.format("j"),
        duration_minutes_by_party_size_str="cast(null as string)",
        duration_dict_ranges_str=durations_sql("0", "(60 + j * 5)"),
    )


def venues(supplier: DataFrame) -> DataFrame:
    return (
        supplier.selectExpr("s_suppkey div 5 as id", "s_name")
        .groupBy("id")
        .agg({"s_name": "min"})
        .selectExpr("named_struct('id', id) as __key__", "`min(s_name)` as name")
    )


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six booking tables, lazily derived from the files in ``sf_dir``."""
    lineitem, part, supplier = (_table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier"))
    return {
        "reservation": reservations(lineitem),
        "shift_default": shift_templates(part),
        "shift_override": overrides(supplier),
        "shift_default_denorm": template_tables(part),
        "shift_override_denorm": override_tables(supplier),
        "venue": venues(supplier),
    }


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows with a made score, for the evaluation operators."""
    return (
        _table(spark, sf_dir, "lineitem")
        .selectExpr(
            "5 * cast(round(100 * l_discount) as bigint) + (l_partkey * 31 + l_suppkey * 7) % 51 as s",
            "l_orderkey as o",
            "l_suppkey div 5 as venue_key_id",
            f"{_SHIFT.format('(l_linenumber % 3)')} as persistent_id",
            "to_date(l_shipdate) as shift_date",
            "cast(l_quantity as int) - 1 as day_prior",
        )
        .selectExpr(
            "shift_date",
            "venue_key_id",
            "persistent_id",
            "day_prior",
            "dayofweek(shift_date) as day_of_week",
            "cast(s + (o * 13) % 60 > 80 as int) as is_hot",
            "s / 100.0D as hot_probability",
        )
    )


def raw_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose numbers arrive as text, some unreadable."""
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "case when l_partkey % 10 = 0 then 'n/a' else cast(cast(l_extendedprice as bigint) as string) end as util_capacity",
        "case when l_partkey % 15 = 0 then '' when l_partkey % 7 = 3 then null "
        "else cast(cast(l_quantity as bigint) as string) end as covers_as_of_date",
        "cast(l_tax > 0.04 as int) as is_hot",
    )
