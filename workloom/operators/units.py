"""Quantities recorded in different units, brought to one: pay in roubles per month.

Every bound has three units: its currency, the period it is paid for and the scale of the number
(1, a thousand, a million). A unit that the row states is taken as stated. A missing one is
predicted by a tree ensemble from magnitude (in roubles where the currency is known), source,
category and the neighbouring fields, with probabilities calibrated on held-out rows; confident
predictions are converted, the others go to review. Where the data's owner vouches for rules
(`conventions`), these check the predictions: one that contradicts them goes to review too, and
the rules settle what is under review.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workloom.runtime import materialise, release, small

#: Rows that the ensemble is fitted on at most, and rows held out to calibrate it. Labelled rows are
#: picked by the hash of their id, so the choice is the same for any partitioning.
TRAIN_ROWS, HELD_ROWS = 12_000, 4_000
#: Calibrated probability from which a predicted unit is used.
CONFIDENT = 0.9

# How texts and the currency column name currencies (first match wins).
CURRENCY_WORDS = (
    ("USD", r"\$|usd|долл|dollar"),
    ("EUR", r"€|eur|евро"),
    ("KZT", r"kzt|₸|тенге|(?<![а-я])тг"),
    ("BYN", r"byn|byr|бел\.?\s*руб|(?<![a-z])br(?![a-z])"),
    ("UZS", r"uzs|(?<![а-я])сум"),
    ("CNY", r"cny|¥|юан"),
    ("RUB", r"руб|₽|rub|rur|т\.\s?р|(?<![а-я])р\.|(?<![а-я])р(?![а-я])"),
)
# How texts name pay periods; the keys are those of pay_periods.
PERIOD_WORDS = (
    ("hour", r"(?<![а-я])час|hour|(?<![a-z])hr(?![a-z])|(?<![a-z])h(?![a-z])"),
    ("shift", r"смен|shift"),
    ("week", r"недел|week|(?<![a-z])wk(?![a-z])"),
    ("year", r"(?<![а-я])год|year|annual|annum|(?<![a-z])yr(?![a-z])"),
    ("month", r"(?<![а-я])мес|month"),
)
# Scale words directly after a number.
SCALE_WORDS = (
    (1_000, r"т\.\s?р|тыс|тр(?![а-я])|[kк](?![a-zа-я])"),
    (1_000_000, r"млн|миллион|million|mln|[mм](?![a-zа-я])"),
)
NUMBER = r"(\d{1,3}(?:[\s    '’]\d{3})+(?!\d)|\d+(?:[.,]\d+)?)"
SCALED = NUMBER + r"[\s  ]*(т\.\s?р|тыс|тр(?![а-я])|млн|миллион|million|mln|[kкmм](?![a-zа-я]))?"


def _named(text: Column, words) -> Column:
    return reduce(lambda rest, w: F.when(text.rlike(w[1]), w[0]).otherwise(rest), reversed(words), F.lit(None))


def _scale_of(word: Column) -> Column:
    return reduce(lambda rest, w: F.when(word.rlike("^(?:" + w[1] + ")"), F.lit(w[0]).cast("bigint")).otherwise(rest), SCALE_WORDS, F.lit(None).cast("bigint"))


def stated_units(df: DataFrame, text: str, currency: str, lo: str, hi: str) -> DataFrame:
    """Adds what each row says of its units: s_currency, s_period, and s_lo, s_hi: the scale of a
    bound that the text prints with the recorded digits (a scale word after either printed number
    serves both), 1 if printed without any, null if the text doesn't print it. Nulls state nothing."""
    t = F.lower(F.col(text))
    numbers = F.transform(F.regexp_extract_all(t, F.lit(SCALED), F.lit(1)), lambda x: F.regexp_replace(x, r"[^\d.,]", ""))
    words = F.regexp_extract_all(t, F.lit(SCALED), F.lit(2))
    df = df.withColumns({"_t": t, "_numbers": numbers, "_words": words})
    df = df.withColumn("_scales", F.transform("_words", _scale_of))
    df = df.withColumn("_shared", F.get(F.filter("_scales", lambda s: s.isNotNull()), 0))

    def scale(bound: str, last: bool) -> Column:
        hits = F.filter(
            F.arrays_zip(F.col("_numbers").alias("n"), F.col("_scales").alias("s")),
            lambda x: x["n"] == F.col(bound).cast("string"),
        )
        hit = F.element_at(F.when(F.size(hits) > 0, hits), -1 if last else 1)
        return F.when(hit.isNotNull(), F.coalesce(hit["s"], F.col("_shared"), F.lit(1)).cast("bigint"))

    return df.withColumns(
        {
            "s_currency": F.coalesce(_named(F.lower(F.col(currency)), CURRENCY_WORDS), _named(F.col("_t"), CURRENCY_WORDS)),
            "s_period": _named(F.col("_t"), PERIOD_WORDS),
            "s_lo": scale(lo, False),
            "s_hi": scale(hi, True),
        }
    ).drop("_t", "_numbers", "_words", "_scales", "_shared")


class UnitModel:
    """A random forest for one unit with isotonic calibration of its top probability.

    fit: labelled has the columns `label` (string), `_held` (for calibration) and the numeric feature
    columns. With fewer than two labels to learn from, the only label (or null) is predicted, with
    the probability that Laplace's rule gives it; without held-out rows nothing is confident.
    """

    TREES, DEPTH = 20, 7

    def __init__(self, features: list[str], seed: int = 7):
        self.features, self.seed, self.labels, self.model, self.curve = features, seed, [], None, None

    def fit(self, labelled: DataFrame) -> UnitModel:
        from pyspark.ml.classification import RandomForestClassifier
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.regression import IsotonicRegression

        counts: dict[str, int] = {}
        held = 0
        for r in labelled.groupBy("label", "_held").count().collect():  # a few rows a unit
            if r["_held"]:
                held += r["count"]
            else:
                counts[r["label"]] = r["count"]
        self.labels = sorted(counts, key=lambda x: (-counts[x], x))
        self.sure = (sum(counts.values()) + 1) / (sum(counts.values()) + 2)
        self.vector = VectorAssembler(inputCols=self.features, outputCol="_features", handleInvalid="keep")
        if len(self.labels) < 2:
            return self
        index = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(self.labels) for x in (k, float(i))]), F.col("label"))
        data = self.vector.transform(labelled.withColumn("_y", index))
        forest = RandomForestClassifier(featuresCol="_features", labelCol="_y", numTrees=self.TREES, maxDepth=self.DEPTH, maxBins=64, seed=self.seed)
        self.model = forest.fit(data.where("not _held"))
        if held:
            right = self._top(self.model.transform(data.where("_held"))).select("_p", F.coalesce(F.col("_label") == F.col("label"), F.lit(False)).cast("double").alias("_right"))
            self.curve = IsotonicRegression(featuresCol="_p", labelCol="_right", predictionCol="_sure").fit(right)
        return self

    def _top(self, scored: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        names = F.array(*[F.lit(x) for x in self.labels])
        scored = scored.withColumn("_p", F.array_max(vector_to_array(F.col("probability"))))
        return scored.withColumn("_label", F.element_at(names, F.col("prediction").cast("int") + 1))

    def predict(self, df: DataFrame, label: str, p: str) -> DataFrame:
        if self.model is None:
            only = self.labels[0] if self.labels else None
            return df.withColumns({label: F.lit(only).cast("string"), p: F.lit(self.sure if self.labels else 0.0)})
        keep = [F.col(c) for c in df.columns]
        scored = self._top(self.model.transform(self.vector.transform(df)))
        scored = scored.withColumn("_sure", F.lit(0.0)) if self.curve is None else self.curve.transform(scored)
        return scored.select(*keep, F.col("_label").alias(label), F.col("_sure").alias(p))


def _log(c: Column) -> Column:
    return F.coalesce(F.log10(F.greatest(c.cast("double"), F.lit(1e-9))), F.lit(-9.0))


def _code(c: str, values: list[str]) -> Column:
    return reduce(lambda rest, iv: F.when(F.col(c) == iv[1], float(iv[0] + 1)).otherwise(rest), enumerate(values), F.lit(0.0))


#: Features for each unit: never one that holds the unit itself.
FEATURES = {
    "currency": ["f_lo", "f_hi", "f_width", "f_source", "f_text", "f_period", "f_scale"],
    "scale": ["f_bound", "f_roubles", "f_other", "f_width", "f_source", "f_text", "f_currency", "f_period"],
    "period": ["f_roubles", "f_lo", "f_hi", "f_width", "f_source", "f_text", "f_currency", "f_scale"],
}


def _described(df: DataFrame) -> DataFrame:
    """What all three units are predicted from: source, category and the shape of the pay."""
    return df.withColumns({
        "f_lo": _log(F.col("_lo")), "f_hi": _log(F.col("_hi")), "f_width": F.coalesce(F.try_divide(F.col("_hi").cast("double"), F.col("_lo")), F.lit(0.0)),
        "f_source": F.pmod(F.xxhash64("source"), F.lit(16)).cast("double"), "f_text": F.when(F.col("_has_text"), 1.0).otherwise(0.0),
        "f_currency": _code("s_currency", [w[0] for w in CURRENCY_WORDS]), "f_period": _code("s_period", [w[0] for w in PERIOD_WORDS]),
        "f_scale": _log(F.coalesce("s_lo", "s_hi")),
    })


def _bound(df: DataFrame, this: str, other: str) -> DataFrame:
    """The features of one bound's scale: its size, in roubles too, beside the other bound."""
    return df.withColumns({"f_bound": _log(F.col(this)), "f_roubles": _log(F.col(this) * F.col("_rate")), "f_other": _log(F.col(other))})


def _sampled(labelled: DataFrame, features: list[str]) -> DataFrame:
    """The labelled rows that a model is fitted on and calibrated with: those with the least hash of their
    id, at most TRAIN_ROWS + HELD_ROWS; the choice doesn't depend on the partitioning."""
    rows = labelled.where("label is not null").select("label", *features, F.xxhash64("parse_id", F.lit(11)).alias("_pick"))
    rows = rows.orderBy("_pick", "label", *features).limit(TRAIN_ROWS + HELD_ROWS)
    return materialise(rows.withColumn("_held", F.pmod(F.col("_pick"), F.lit(TRAIN_ROWS + HELD_ROWS)) < HELD_ROWS).drop("_pick").coalesce(4), "labels")


def predicted_units(df: DataFrame) -> DataFrame:
    """df of stated_units with p_ and q_, the predicted unit and its calibrated probability, of currency,
    period, scale_lo and scale_hi. A model is fitted only where some row lacks the unit. The scale
    comes before the period, which is then predicted from the size of the whole amount."""
    df = _described(df)
    lacks = df.agg(*[F.max(c.cast("int")).alias(n) for n, c in (
        ("currency", F.col("s_currency").isNull()), ("period", F.col("s_period").isNull()),
        ("scale", (F.col("_lo").isNotNull() & F.col("s_lo").isNull()) | (F.col("_hi").isNotNull() & F.col("s_hi").isNull())),
    )]).first()

    def model(unit: str, labelled: DataFrame) -> UnitModel | None:
        if not lacks[unit]:
            return None
        sample = _sampled(labelled, FEATURES[unit])
        fitted = UnitModel(FEATURES[unit]).fit(sample)
        release(sample)
        return fitted

    def add(df: DataFrame, unit: UnitModel | None, name: str) -> DataFrame:
        none = {f"p_{name}": F.lit(None).cast("string"), f"q_{name}": F.lit(0.0)}
        return df.withColumns(none) if unit is None else unit.predict(df, f"p_{name}", f"q_{name}")

    df = add(df, model("currency", df.withColumn("label", F.col("s_currency"))), "currency")
    sides = {"lo": ("_lo", "_hi"), "hi": ("_hi", "_lo")}
    known = [_bound(df, *v).withColumn("label", F.col(f"s_{k}").cast("string")) for k, v in sides.items()]
    scale = model("scale", known[0].unionByName(known[1]))
    for k, v in sides.items():
        df = add(_bound(df, *v), scale, k)
    whole = F.coalesce(F.col("_hi") * F.coalesce("s_hi", F.col("p_hi").cast("bigint"), F.lit(1)), F.col("_lo") * F.coalesce("s_lo", F.col("p_lo").cast("bigint"), F.lit(1)))
    df = df.withColumn("f_roubles", _log(whole * F.col("_rate")))
    df = add(df, model("period", df.withColumn("label", F.col("s_period"))), "period")
    return df.drop(*{f for names in FEATURES.values() for f in names})


def daily_rates(rates: DataFrame, until) -> DataFrame:
    """(code, day, num, den): roubles per unit as an exact fraction, for every day up to `until` with
    the latest rate at or before it. Codes are compared without case; repeated rows count once, and
    of different rates of one day the greatest counts; rows with a null or a nominal below 1 are left out.
    RUB needs no row: it is 1 on every day."""
    clean = (
        rates.where("date is not null and char_code is not null and value is not null and nominal > 0")
        .select(F.upper(F.trim("char_code")).alias("code"), "date", F.struct(F.col("value").cast("decimal(20,6)").alias("v"), "nominal").alias("r"))
        .groupBy("code", "date")
        .agg(F.max_by("r", F.col("r.v") / F.col("r.nominal")).alias("r"))
    )
    w = Window.partitionBy("code").orderBy("date")
    spans = clean.withColumn("to", F.coalesce(F.date_sub(F.lead("date").over(w), 1), F.greatest(F.lit(until).cast("date"), F.col("date"))))
    days = spans.select("code", F.explode(F.sequence("date", "to")).alias("day"), (F.col("r.v") * 1_000_000).cast("decimal(26,0)").alias("num"), (F.col("r.nominal").cast("bigint") * 1_000_000).alias("den"))
    return days.where("code not in ('RUB', 'RUR')")


def with_units(parses: DataFrame, rates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, days): the rows with a bound, what they state of their units and what is predicted, written to
    the shared folder; and daily_rates up to the last of them."""
    base = parses.where("min is not null or max is not null").select(
        "parse_id", "source", "posted_on", F.col("min").alias("_lo"), F.col("max").alias("_hi"), F.col("salary_text").alias("_text"), F.col("currency").alias("_cur")
    )
    base = stated_units(base, "_text", "_cur", "_lo", "_hi").withColumn("_has_text", F.col("_text").isNotNull()).drop("_text", "_cur")
    days = small(daily_rates(rates, parses.agg(F.max("posted_on")).first()[0]))
    rate = F.when(F.col("s_currency") == "RUB", F.lit(1.0)).otherwise(F.col("_num").cast("double") / F.col("_den"))
    rated = days.select(F.col("code").alias("s_currency"), F.col("day").alias("posted_on"), F.col("num").alias("_num"), F.col("den").alias("_den"))
    base = base.join(rated, ["s_currency", "posted_on"], "left").withColumn("_rate", rate).drop("_num", "_den")
    base = materialise(base, "stated")
    rows = materialise(predicted_units(base), "units")
    release(base)
    return rows, days


def monthly_roubles(parses: DataFrame, rates: DataFrame, periods: DataFrame, *, conventions: bool = True, confident: float = CONFIDENT) -> DataFrame:
    """Both bounds of each row in whole roubles per month (half up from the exact product).

    Returns parse_id, rub_min, rub_max, the units used (currency, period, scale_min, scale_max),
    where each came from (stated, predicted, review) and `review`: null if converted, else why
    not (currency, period, scale or rate).

    A missing unit is the predicted one if its calibrated probability is at least `confident`; otherwise
    the row goes to review. conventions: a text that names no period means a month, and a number
    that the text doesn't print with the recorded digits is already in full units. With them a
    confident prediction must also agree, and what is under review is settled by them (`review`
    in the column that says where a unit came from); without them it stays there.

    Defined cases: rows with neither bound give no row; a null text or currency states nothing; a
    bound that is null stays null; repeated rows give repeated rows; a day before a currency's first
    rate goes to review; empty tables give an empty result. Further columns are not looked at.
    """
    rows, days = with_units(parses, rates)
    return settled(rows, days, periods, conventions=conventions, confident=confident)


def settled(rows: DataFrame, days: DataFrame, periods: DataFrame, *, conventions: bool, confident: float = CONFIDENT) -> DataFrame:
    """monthly_roubles from the result of with_units."""
    days = days.alias("d")

    def decide(stated: Column, name: str, rule: Column | None, kind: str) -> tuple[Column, Column]:
        guess = F.when(F.col(f"q_{name}") >= confident, F.col(f"p_{name}").cast(kind))
        if rule is not None:
            guess = F.when(guess == rule, guess)
        unit = F.coalesce(stated, guess, F.lit(None) if rule is None else rule)
        return unit, F.when(stated.isNotNull(), "stated").when(guess.isNotNull(), "predicted").otherwise("review")

    usual = lambda value: F.lit(value) if conventions else None
    currency = decide(F.col("s_currency"), "currency", None, "string")
    period = decide(F.col("s_period"), "period", usual("month"), "string")
    low, high = (decide(F.col(f"s_{x}"), x, usual(1), "bigint") for x in ("lo", "hi"))
    has = lambda c, x: F.when(F.col(c).isNotNull(), x)
    came = F.array(F.coalesce(has("_lo", low[1]), F.lit("")), F.coalesce(has("_hi", high[1]), F.lit("")))
    both = F.when(F.array_contains(came, "review"), "review").when(F.array_contains(came, "predicted"), "predicted").otherwise("stated")
    used = rows.select(
        "parse_id", "posted_on", "_lo", "_hi", currency[0].alias("currency"), period[0].alias("period"),
        has("_lo", low[0]).alias("scale_min"), has("_hi", high[0]).alias("scale_max"),
        currency[1].alias("currency_from"), period[1].alias("period_from"), both.alias("scale_from"),
    )
    kinds = small(periods.where("per_month_den > 0").groupBy("period").agg(F.max(F.struct("per_month_num", "per_month_den")).alias("k")))
    joined = used.join(kinds, "period", "left").join(days, (F.col("currency") == F.col("d.code")) & (F.col("posted_on") == F.col("d.day")), "left")
    rub = F.col("currency") == "RUB"
    num, den = F.when(rub, F.lit(1)).otherwise(F.col("d.num")), F.when(rub, F.lit(1)).otherwise(F.col("d.den"))
    wide = lambda c: c.cast("decimal(38,0)")

    def roubles(bound: str, scale: str) -> Column:
        over = wide(wide(F.col(bound) * F.col(scale)) * wide(F.col("k.per_month_num") * num))
        under = wide(F.col("k.per_month_den") * den)
        return _half_up(over, under)

    why = (
        F.when(F.col("currency").isNull(), "currency").when(F.col("k").isNull(), "period")
        .when((F.col("_lo").isNotNull() & F.col("scale_min").isNull()) | (F.col("_hi").isNotNull() & F.col("scale_max").isNull()), "scale")
        .when(num.isNull(), "rate")
    )
    return joined.select(
        "parse_id", roubles("_lo", "scale_min").alias("rub_min"), roubles("_hi", "scale_max").alias("rub_max"),
        "currency", "period", "scale_min", "scale_max", "currency_from", "period_from", "scale_from", why.alias("review"),
    )


def _half_up(over: Column, under: Column) -> Column:
    """over / under as a whole number, halves up, in integers only. Pay isn't negative."""
    top = (over * 2 + under).cast("decimal(38,0)")
    bottom = (under * 2).cast("decimal(38,0)")
    return ((top - top % bottom) / bottom).cast("bigint")
