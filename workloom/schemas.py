"""Declared schemas of the stored tables."""

from pyspark.sql import types as T

from workloom.operators.slim import SLIM


def _t(**fields):
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


S, L, I, D, B, TS, DATE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.TimestampType(), T.DateType()

LAKE = _t(vacancy_id=S, source=S, fetched_at=TS, posted_at=TS, employer_id=S, content_hash=S, raw_json=S, market_scope=S, professional_role_id=L)
EVENTS = _t(event_id=S, vacancy_id=S, employer_id=S, ts=TS, type=S, payload=S, source=S)
RATES = _t(date=DATE, char_code=S, nominal=I, value=D)
DETAILS = _t(vacancy_id=S, fetched_at=TS, description_text=S, description_teaser=S, description_fts=S)
EMBEDDINGS = _t(vacancy_id=S, vector=T.ArrayType(T.FloatType()), text_hash=S)
ROLE_SALARY = _t(week_start=DATE, role_canonical=S, seniority=S, city=S, n_vacancies=L, salary_rub_p25=L, salary_rub_median=L, salary_rub_p75=L)

__all__ = ["SLIM", "LAKE", "EVENTS", "RATES", "DETAILS", "EMBEDDINGS", "ROLE_SALARY"]
