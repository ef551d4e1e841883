"""Mart, segmentation and fleet-slice queries."""

from pyspark.sql import functions as F

from riskloom.catalog.inputs import ROLES, table, units, units_text
from riskloom.catalog.registry import register
from riskloom.operators import aggregates as agg
from riskloom.operators.features import add_features
from riskloom.operators.serving import explore_slice
from riskloom.plans.mart import query
from riskloom.sources.tables import canonical_view, normalise_headers, project_source, sql

Z = "1.959963984540054e0"

COUNTS = """count(*) as n_units,
       count(*) filter (where label) as n_positive"""

AGE_BAND = """case when age <= -0.1 then null when age <= 1 then '0-1 anos (novo)'
       when age <= 3 then '2-3 anos (garantia)' when age <= 5 then '4-5 anos (pos-garantia)'
       when age <= 30 then '6+ anos (maduro)' end"""
USAGE_BAND = """case when usage_km <= -0.1 then null when usage_km <= 25000 then 'ate 25 mil km'
       when usage_km <= 75000 then '25-75 mil km' when usage_km <= 125000 then '75-125 mil km'
       when usage_km <= 500000 then 'acima de 125 mil km' end"""
FEATURES = f"""select *, usage_km / (age + 1e0) as usage_per_year, events / (age + 1e0) as events_per_year,
       case when usage_km = 0 then null else events / (usage_km / 10000e0) end as events_per_10k,
       events >= 3 as many_events, {AGE_BAND} as age_band, {USAGE_BAND} as usage_band
from units"""


def wilson(n: str, k: str) -> str:
    """SQL pieces from a relation holding n and k: centre and margin."""
    p, z2 = f"({k} * 1e0 / {n})", f"({Z} * {Z})"
    spread = f"(1e0 + {z2} / {n})"
    centre = f"(({p} + {z2} / (2e0 * {n})) / {spread})"
    margin = f"({Z} * sqrt({p} * (1e0 - {p}) / {n} + {z2} / (4e0 * {n} * {n})) / {spread})"
    low = f"least(greatest({centre} - {margin}, 0e0), 1e0)"
    high = f"least(greatest({centre} + {margin}, 0e0), 1e0)"
    return f"{low} as ci_low, {high} as ci_high, {high} - {low} as ci_width"


WILSON = wilson("n_units", "n_positive")


@register("unit_table", "select * from units")
def unit_table(spark, sf_dir):
    return units(spark, sf_dir)


@register("canonical_view", "select * from units")
def canonical(spark, sf_dir):
    return canonical_view(units_text(spark, sf_dir), ROLES)


@register(
    "source_with_normalised_headers",
    "select unit_id, grp, age, usage_km, events, case when label then 'Sim' else 'Não' end as label from units",
)
def headers(spark, sf_dir):
    source = units_text(spark, sf_dir).toDF(
        "Unit ID", " GRP", "Âge", "Usage (km)", "EVENTS", "Label"
    )
    renamed = normalise_headers(source)
    return project_source(renamed, ROLES, keep=["unit_id"])


@register(
    "sql_with_parameters",
    f"""select age, {COUNTS}, avg(usage_km) as mean_usage from units
        where usage_km between 20000 and 90000 group by age""",
    "mean_usage",
    places=6,
)
def parameters(spark, sf_dir):
    text = """select age, count(*) as n_units, count(*) filter (where label) as n_positive,
                     avg(usage_km) as mean_usage
              from {units} where usage_km between :low and :high group by age"""
    return sql(units_text(spark, sf_dir), text, ROLES, low=20_000, high=90_000)


# The interval holds the rates q with n (p - q)^2 <= z^2 q (1 - q): the roots of (n + z^2) q^2 - (2 n p + z^2) q + n p^2.
RANKING_SQL = f"""with tally as (select grp, {COUNTS} from units group by grp),
quadratic as (select grp, n_units, n_positive, n_units + {Z} * {Z} as qa, -(2e0 * n_positive + {Z} * {Z}) as qb,
       n_positive * n_positive * 1e0 / n_units as qc, n_positive * 1e0 / n_units as rate from tally),
roots as (select *, sqrt(qb * qb - 4e0 * qa * qc) / qa as full_width from quadratic),
ranked as (select (select count(*) from roots o where o.rate > r.rate or (o.rate = r.rate and o.grp <= r.grp)) as position,
       grp, n_units, n_positive, rate, greatest(0e0, -qb / (2e0 * qa) - full_width / 2e0) as ci_low,
       least(1e0, -qb / (2e0 * qa) + full_width / 2e0) as ci_high, full_width as ci_width from roots r)
final """


@register("risk_ranking", RANKING_SQL + "select * from ranked", "rate ci_low ci_high ci_width")
def risk_ranking(spark, sf_dir):
    return query(units(spark, sf_dir), "risk_ranking", ROLES)


@register(
    "ranking_interval_overlap",
    RANKING_SQL
    + """select arg_min(ci_low, position) as first_low, arg_max(ci_high, position) as last_high,
         arg_min(ci_low, position) <= arg_max(ci_high, position) as overlaps from ranked""",
    "first_low last_high",
)
def overlap(spark, sf_dir):
    return agg.interval_overlap(agg.risk_ranking(units(spark, sf_dir), ROLES))


@register(
    "group_profile",
    f"""select grp, {COUNTS}, avg(case when label then 1e0 else 0e0 end) as rate,
       avg(age) as mean_age, avg(usage_km) as mean_usage, quantile_cont(usage_km, 0.5) as median_usage,
       avg(events) as mean_events, max(events) as max_events from units group by grp""",
    "rate mean_age mean_usage median_usage mean_events",
    places=6,
)
def group_profile(spark, sf_dir):
    return query(units(spark, sf_dir), "group_profile", ROLES)


EVOLUTION_SQL = f"""with cohort as (select age, {COUNTS}, count(*) filter (where label) * 1e0 / count(*) as rate,
  avg(usage_km) as mean_usage, avg(events) as mean_events from units group by age),
running as (select c.*,
  (select cast(sum(o.n_units) as bigint) from cohort o where o.age <= c.age) as cum_units,
  (select cast(sum(o.n_positive) as bigint) from cohort o where o.age <= c.age) as cum_positive,
  (select count(*) filter (where u.label) * 1e0 / count(*) from units u where u.age <= c.age) as cum_rate from cohort c)
final """


@register(
    "evolution_by_age", EVOLUTION_SQL + "select * from running", "rate mean_usage mean_events cum_rate",
    places=6,
)
def evolution(spark, sf_dir):
    return query(units(spark, sf_dir), "evolution_by_age", ROLES)


@register(
    "evolution_with_interval",
    EVOLUTION_SQL + f"select *, {WILSON} from running",
    "rate mean_usage mean_events cum_rate ci_low ci_high ci_width",
    places=6,
)
def evolution_band(spark, sf_dir):
    return agg.evolution_with_interval(units(spark, sf_dir), ROLES)


SEGMENTS_SQL = f"""with features as ({FEATURES}),
cells as (select age_band, usage_band, {COUNTS}, avg(events) as mean_events,
  count(*) filter (where label) * 1e0 / count(*) as rate from features group by age_band, usage_band),
ordered as (select *,
  case age_band when '0-1 anos (novo)' then 0 when '2-3 anos (garantia)' then 1
    when '4-5 anos (pos-garantia)' then 2 when '6+ anos (maduro)' then 3 end as age_band_order,
  case usage_band when 'ate 25 mil km' then 0 when '25-75 mil km' then 1
    when '75-125 mil km' then 2 when 'acima de 125 mil km' then 3 end as usage_band_order from cells)
final """


@register("segment_matrix", SEGMENTS_SQL + "select * from ordered", "rate mean_events")
def segments(spark, sf_dir):
    return query(add_features(units(spark, sf_dir), ROLES), "segment_matrix", ROLES)


@register(
    "segment_matrix_suppressed",
    SEGMENTS_SQL + "select * replace (case when n_units >= 20 then rate end as rate) from ordered",
    "rate mean_events",
)
def suppressed(spark, sf_dir):
    cells = agg.segment_matrix(add_features(units(spark, sf_dir), ROLES), ROLES)
    return agg.suppress_small_cells(cells)


def _grid(measure: str, kind: str = "") -> str:
    picks = ", ".join(
        f"max(case when usage_band = '{b}' then {measure} end) as \"{b}\""
        for b in ("ate 25 mil km", "25-75 mil km", "75-125 mil km", "acima de 125 mil km")
    )
    return f"""select b.age_band, b.age_band_order, {picks}
from (values ('0-1 anos (novo)', 0), ('2-3 anos (garantia)', 1), ('4-5 anos (pos-garantia)', 2),
             ('6+ anos (maduro)', 3)) as b(age_band, age_band_order)
left join ordered o on o.age_band = b.age_band group by b.age_band, b.age_band_order"""


GRID_NAMES = '"ate 25 mil km" "25-75 mil km" "75-125 mil km" "acima de 125 mil km"'


def _rounded_grid(measure: str) -> str:
    inner = _grid(measure)
    for b in ("ate 25 mil km", "25-75 mil km", "75-125 mil km", "acima de 125 mil km"):
        inner = inner.replace(f"then {measure} end) as \"{b}\"", f"then round({measure}, 9) end) as \"{b}\"")
    return inner


for _measure in ("rate", "n_units", "mean_events"):

    def _pivot(spark, sf_dir, measure=_measure):
        cells = agg.segment_matrix(add_features(units(spark, sf_dir), ROLES), ROLES)
        return agg.segment_pivot(cells, measure)

    _sql = _grid(_measure) if _measure == "n_units" else _rounded_grid(_measure)
    register(f"segment_grid_{_measure}", SEGMENTS_SQL + _sql)(_pivot)


@register(
    "rate_by_group",
    f"""select *, {WILSON} from (select grp, {COUNTS}, count(*) filter (where label) * 1e0 / count(*) as rate
        from units group by grp)""",
    "rate ci_low ci_high ci_width",
)
def by_group(spark, sf_dir):
    return agg.rate_by_level(units(spark, sf_dir), "grp", ROLES)


@register(
    "rate_by_events_well_filled",
    f"""select *, {WILSON} from (select events, {COUNTS}, count(*) filter (where label) * 1e0 / count(*) as rate
        from units group by events having count(*) >= 10)""",
    "rate ci_low ci_high ci_width",
)
def by_events(spark, sf_dir):
    return agg.rate_by_events(units(spark, sf_dir), ROLES)


@register(
    "document_quality_by_source",
    f"""select *, {WILSON} from (select source, {COUNTS}, count(*) filter (where label) * 1e0 / count(*) as rate
        from (select d.source, l.quality = 1 as label from documents d join labels l on d.doc_id = l.doc_id)
        group by source)""",
    "rate ci_low ci_high ci_width",
    views=(),
)
def document_quality(spark, sf_dir):
    labelled = (
        table(spark, sf_dir, "documents")
        .select("doc_id", "source")
        .join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
        .withColumn("label", F.col("quality") == 1)
    )
    return agg.rate_by_level(labelled, "source", ROLES)


@register(
    "events_contingency",
    """select events, count(*) filter (where not label) as n_negative,
       count(*) filter (where label) as n_positive from units group by events""",
)
def contingency(spark, sf_dir):
    return agg.contingency(units(spark, sf_dir), "events", ROLES)


@register(
    "usage_histogram_by_outcome",
    """with r as (select label, min(usage_km) * 1e0 as low, max(usage_km) * 1e0 as high from units group by label),
b as (select u.label, case when high = low then 0
        else cast(least(floor((usage_km - low) / ((high - low) / 22e0)), 21) as integer) end as bin,
        low, (high - low) / 22e0 as width from units u join r on u.label = r.label)
final select label, bin, low + bin * width as bin_from, low + (bin + 1) * width as bin_to, count(*) as n
from b group by label, bin, low, width""",
    "bin_from bin_to",
    places=6,
)
def histogram(spark, sf_dir):
    return agg.histogram(units(spark, sf_dir), "usage_km", "label")


@register(
    "target_distribution",
    "select label, count(*) as n, count(*) * 1e0 / (select count(*) from units) as share from units group by label",
    "share",
)
def distribution(spark, sf_dir):
    return agg.target_distribution(units(spark, sf_dir), ROLES)


@register(
    "category_summary",
    """with c as (select grp as level, count(*) as n from units group by grp)
final select 'grp' as variable, count(*) as n_levels,
  (select level from c order by n desc, level limit 1) as mode,
  (select n from c order by n desc, level limit 1) as mode_n,
  (select n from c order by n desc, level limit 1) * 1e0 / cast(sum(n) as double) as mode_share,
  (select level from c order by n, level limit 1) as rarest,
  (select n from c order by n, level limit 1) as rarest_n from c""",
    "mode_share",
)
def categories(spark, sf_dir):
    return agg.category_summary(units(spark, sf_dir), ["grp"])


@register(
    "fleet_totals",
    f"""select {COUNTS}, avg(age) as mean_age, avg(usage_km) as mean_usage, avg(events) as mean_events,
        count(*) filter (where label) * 1e0 / count(*) as rate from units""",
    "mean_age mean_usage mean_events rate",
    places=6,
)
def totals(spark, sf_dir):
    return agg.fleet_totals(units(spark, sf_dir), ROLES)


@register(
    "slice_explorer",
    f"""with features as ({FEATURES}),
s as (select {COUNTS}, avg(events) as mean_events, (select count(*) from units) as n_base from features
      where grp in ('BUILDING', 'MACHINERY') and age_band in ('4-5 anos (pos-garantia)', '6+ anos (maduro)'))
final select n_units, n_positive, mean_events, n_units * 1e0 / n_base as share_of_base,
  n_positive * 1e0 / n_units as rate, {WILSON}, n_units < 20 as small_sample from s""",
    "mean_events share_of_base rate ci_low ci_high ci_width",
)
def explorer(spark, sf_dir):
    features = add_features(units(spark, sf_dir), ROLES)
    return explore_slice(
        features,
        {
            "grp": ["BUILDING", "MACHINERY"],
            "age_band": ["4-5 anos (pos-garantia)", "6+ anos (maduro)"],
            "usage_band": [],
        },
        ROLES,
    )
