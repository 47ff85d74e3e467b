"""Model preparation: feature registry, route support rule, fitted preprocessing.

Numeric columns are imputed with the exact training median and optionally
standardised with the training mean and population standard deviation --
both are plain column expressions with constants fitted by one aggregate
over the training split (bounded: one number per feature). Categorical
columns go through StringIndexer(keep) + OneHotEncoder(dropLast), so an
unseen category becomes the all-zero vector.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config, schema
from ..functions.scalar import col
from ..operators import profile as PR

IGNORED = {"delay_target", "flight_date", "observation_timestamp", "scheduled_departure_ts"}


def route_support(df: DataFrame) -> DataFrame:
    """M4 rule input: rows, distinct routes, rows per route (2 dp)."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("total_records"),
                  F.count_distinct("route").cast("long").alias("unique_routes")).withColumn(
        "avg_records_per_route",
        F.rint(F.col("total_records") / F.greatest(F.col("unique_routes"), F.lit(1)) * 100) / 100)


def feature_groups(df: DataFrame, target: str = "delay_target", include_route: bool = False,
                   min_rows_per_route: float = 3.0, exclude: list[str] | None = None,
                   key: list[str] | None = None) -> tuple[list[str], list[str], dict]:
    """M4: numeric vs categorical by type after leakage filtering; ``route``
    only when it has enough rows per level (or is forced)."""
    ignore = set(IGNORED) | set(config.OUTCOME_COLUMNS) | {target} | set(exclude or []) | set(key or [])
    meta: dict = {}
    if "route" in df.columns and not include_route:
        r = route_support(df).first()
        meta = r.asDict()
        if r["avg_records_per_route"] < min_rows_per_route:
            ignore.add("route")
            meta["decision"] = "EXCLUDED"
        else:
            meta["decision"] = "INCLUDED"
    cols = [c for c in schema.leakage_safe_features(df.columns, target) if c not in ignore]
    num = [c for c in cols if c in PR.numeric_columns(df)]
    cat = [c for c in cols if c in PR.string_columns(df)]
    return num, cat, meta


def refuse_outcomes(df: DataFrame) -> None:
    """A table with a post-flight column must not be modelled."""
    found = [c for c in df.columns if c in config.OUTCOME_COLUMNS]
    if found:
        raise ValueError(f"post-flight columns in the feature table: {found}")


def registry_v6(df: DataFrame, target: str = "delay_target", key: list[str] | None = None,
                fixed_list: bool = False) -> tuple[list[str], list[str], list[str]]:
    """M6: drop constant columns (detected from data unless ``fixed_list``),
    every duplicate column (historical aliases and the four other repeats),
    ``route`` and identifiers; outcome columns are an error."""
    refuse_outcomes(df)
    from ..operators.prior import P3_ALIASES
    constants = config.V6_FIXED_CONSTANTS if fixed_list else PR.constant_columns(df)
    aliases = {a for a, _ in P3_ALIASES} | set(config.V6_EXTRA_ALIASES)
    drop = set(constants) | aliases | {"route"} | set(key or [])
    num, cat, _ = feature_groups(df, target, include_route=True, exclude=list(drop), key=key)
    return num, cat, sorted(set(constants))


@dataclass
class Preprocessor:
    numeric: list[str]
    categorical: list[str]
    scale: bool = False
    medians: dict[str, float] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)
    encoder: PipelineModel | None = None

    def fit(self, train: DataFrame) -> "Preprocessor":
        found = {r["feature"]: r["median"] for r in median_table(train, self.numeric).collect()} if self.numeric else {}
        self.medians = {c: found.get(c) for c in self.numeric}  # one number a feature
        if self.scale:
            # the mean/std are of the imputed column, as after a median fill
            filled = train.select(*[F.coalesce(col(c).cast("double"), F.lit(self.medians[c] or 0.0)).alias(c)
                                    for c in self.numeric])
            r2 = filled.agg(*[F.avg(col(c)).alias(f"mean__{c}") for c in self.numeric],
                            *[F.stddev_pop(col(c)).alias(f"std__{c}") for c in self.numeric]).first().asDict()
            self.means = {c: r2[f"mean__{c}"] for c in self.numeric}
            self.stds = {c: r2[f"std__{c}"] for c in self.numeric}
        stages = []
        if self.categorical:
            # one indexer for all categorical columns: a single counting pass
            stages.append(StringIndexer(inputCols=[f"_cat_{c}" for c in self.categorical],
                                        outputCols=[f"_idx_{c}" for c in self.categorical], handleInvalid="keep",
                                        stringOrderType="alphabetAsc"))
            stages.append(OneHotEncoder(inputCols=[f"_idx_{c}" for c in self.categorical],
                                        outputCols=[f"_ohe_{c}" for c in self.categorical], dropLast=True))
        stages.append(VectorAssembler(inputCols=[f"_num_{c}" for c in self.numeric]
                                      + [f"_ohe_{c}" for c in self.categorical], outputCol="features"))
        self.encoder = Pipeline(stages=stages).fit(self._columns(train))
        return self

    def _columns(self, df: DataFrame) -> DataFrame:
        add = {}
        for c in self.numeric:
            x = F.coalesce(col(c).cast("double"), F.lit(float(self.medians.get(c) or 0.0)))
            if self.scale:
                sd = self.stds.get(c) or 0.0
                x = (x - F.lit(float(self.means.get(c) or 0.0))) / F.lit(sd if sd > 0 else 1.0)
            add[f"_num_{c}"] = x
        for c in self.categorical:
            add[f"_cat_{c}"] = F.coalesce(col(c).cast("string"), F.lit("missing"))
        return df.withColumns(add)

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.encoder.transform(self._columns(df))
        tmp = [c for c in out.columns if c.startswith(("_num_", "_cat_", "_idx_", "_ohe_"))]
        return out.drop(*tmp)

    def feature_names(self) -> list[str]:
        """M8: numeric names, then ``column_level`` for every kept level."""
        names = list(self.numeric)
        idx = [s for s in self.encoder.stages if hasattr(s, "labelsArray")]
        if idx:
            for c, labels in zip(self.categorical, idx[0].labelsArray):
                names += [f"{c}_{lvl}" for lvl in labels]
        return names

    def unscaled(self) -> "Preprocessor":
        """Same medians and fitted category encoder, without standardisation
        (the assembler reads the same column names, so the encoder is shared)."""
        return Preprocessor(self.numeric, self.categorical, False, dict(self.medians), {}, {}, self.encoder)


def median_table(train: DataFrame, cols: list[str]) -> DataFrame:
    """Exact training medians as a long table (the imputation constants)."""
    return PR.quantiles(PR._long(train, cols), ["column_name"], [0.5]).select(
        F.col("column_name").alias("feature"), F.col("q")[0].alias("median"))


def registry_v4(df: DataFrame, target: str = "delay_target", key: list[str] | None = None,
                include_route: bool = False) -> tuple[list[str], list[str], list[str]]:
    """M5: every column but identifiers, dates, a too sparse ``route`` and
    ``cancelled`` / ``diverted`` where they are constant. Aliases stay;
    outcome columns are an error."""
    refuse_outcomes(df)
    flags = [c for c in ("cancelled", "diverted") if c in df.columns]
    const = []
    if flags:
        r = df.agg(*[F.min(col(c)).alias(f"lo_{c}") for c in flags], *[F.max(col(c)).alias(f"hi_{c}") for c in flags]).first()
        const = [c for c in flags if r[f"lo_{c}"] == r[f"hi_{c}"]]
    num, cat, _ = feature_groups(df, target, include_route=include_route, exclude=const, key=key)
    return num, cat, sorted(const)
