"""Lake rows from raw payloads: ids, dates, employer, role and content hash of board items and chat messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workloom.functions.extract import canonical_json, hash_of_json
from workloom.schemas import LAKE

# Fields of a board item's search shape that change without the posting changing.
VOLATILE = (
    "responsesCount", "totalResponsesCount", "online_users_count", "searchRid", "clickUrl",
    "userLabels", "notify", "inboxPossibility", "chatWritePossibility", "@isAdv",
)
# The spellings under which payloads carry a professional role, in order of precedence,
# and the fields of a role that hold its id.
ROLE_KEYS = ("professional_roles", "professionalRoles", "professionalRoleIds", "professional_role", "professionalRole", "professional_role_id", "professionalRoleId")
ROLE_ID_KEYS = ("id", "@id", "professionalRoleId", "professional_role_id")
#: Lists and objects inside each other that a role id is looked for in.
ROLE_DEPTH = 3

_ISO = r"^\d{4}-\d\d-\d\d(?:[T ]\d\d:\d\d(?::\d\d(?:\.\d{1,9})?)?)?(?:Z|[+-]\d\d(?::?\d\d)?)?$"


def iso_timestamp(text: Column) -> Column:
    """The moment of an ISO 8601 text; without an offset in the session's time zone, null if it is none."""
    t = F.trim(text)
    offset = F.regexp_replace(t, r"([+-]\d\d):?(\d\d)$", "$1:$2")
    offset = F.regexp_replace(offset, r"(T[\d:.]+[+-]\d\d)$", "$1:00")
    return F.when(t.rlike(_ISO), F.try_to_timestamp(offset))


def nested_time(item: Column, field: str) -> Column:
    """The text of a time that is either plain or an object with the ISO text under `$`."""
    plain = F.get_json_object(item, f"$.{field}")
    inside = F.try_variant_get(F.try_parse_json(item), f"$.{field}['$']", "string")
    return F.coalesce(inside, F.when(~plain.startswith("{"), plain))


def _text(value: Column, key: str) -> Column:
    return F.get_json_object(value, f"$['{key}']")


def role_id(item: Column, depth: int = ROLE_DEPTH) -> Column:
    """The professional role of a payload: the first of ROLE_KEYS that leads to a whole number, directly, in
    the first element of a list that does, or as the id of an object; null if none does."""

    def first(values: Column, left: int) -> Column:
        # one lambda a level binds each value once, so the expression grows with the depth only
        return F.get(F.filter(F.transform(values, lambda v: of(v, left)), lambda x: x.isNotNull()), 0)

    def of(v: Column, left: int) -> Column:
        number = v.try_cast("bigint")
        if not left:
            return number
        ids = F.filter(F.array(*[_text(v, k) for k in ROLE_ID_KEYS]), lambda x: ~x.isin("", "0", "false", "[]", "{}"))
        inside = F.when(v.startswith("{"), F.slice(ids, 1, 1)).when(v.startswith("["), F.from_json(v, "array<string>"))
        return F.coalesce(number, first(inside, left - 1))

    return first(F.array(*[_text(item, k) for k in ROLE_KEYS]), depth)


def source_of(vacancy_id: Column) -> Column:
    """The source that an id names by its prefix; null for another form."""
    return F.when(vacancy_id.startswith("hh:"), "hh").when(vacancy_id.startswith("tg:"), "telegram")


def bare_id(vacancy_id: Column) -> Column:
    """The board's number of an id."""
    return F.when(vacancy_id.startswith("hh:"), F.split_part(vacancy_id, F.lit(":"), F.lit(2)))


def _present(c: Column) -> Column:
    return F.when(~c.isin("", "0", "false"), c)


def _lake_row(items: DataFrame, fetched_at: Column, scope: str | None, **columns: Column) -> DataFrame:
    rows = items.select(*[c.alias(k) for k, c in columns.items()], fetched_at.alias("fetched_at"), F.lit(scope).cast("string").alias("market_scope"))
    return rows.select(*[F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in LAKE.fields])


def board_records(items: DataFrame, item: str, fetched_at: Column, scope: str | None = None) -> DataFrame:
    """Rows of LAKE from board items as JSON texts, of either shape: the search shape has vacancyId and company,
    the API shape id and employer. The hash leaves out fields that change by themselves in the search
    shape; the stored payload is whole, with sorted keys.

    Defined cases: an item without an id, or that isn't JSON, gives no row; missing or malformed dates and
    roles are null; further columns of `items` are not looked at."""
    j = F.col(item)
    search, api = _present(_text(j, "vacancyId")), _present(_text(j, "id"))
    rows = items.select(j.alias("_j"), F.coalesce(search, api).alias("_id"), search.isNotNull().alias("_search")).where("_id is not null")
    j = F.col("_j")
    posted = F.when(F.col("_search"), F.coalesce(nested_time(j, "publicationTime"), nested_time(j, "creationTime"))).otherwise(F.coalesce(_present(_text(j, "published_at")), _text(j, "created_at")))
    employer = F.when(F.col("_search"), F.get_json_object(j, "$.company.id")).otherwise(F.get_json_object(j, "$.employer.id"))
    return _lake_row(
        rows, fetched_at, scope, vacancy_id=F.concat(F.lit("hh:"), "_id"), source=F.lit("hh"), posted_at=iso_timestamp(posted), employer_id=_present(employer),
        content_hash=F.when(F.col("_search"), hash_of_json(j, VOLATILE)).otherwise(hash_of_json(j)), raw_json=_sorted_json(j), professional_role_id=role_id(j),
    )


def _sorted_json(text: Column) -> Column:
    @F.pandas_udf("string")
    def whole(texts):
        return texts.map(canonical_json)

    return whole(text)


def chat_records(messages: DataFrame, fetched_at: Column, scope: str | None = None) -> DataFrame:
    """Rows of LAKE from chat messages (channel, message_id, date, text, views). Null channels or message ids give
    no row; repeated rows give repeated rows."""
    known = messages.where("channel is not null and message_id is not null")
    payload = F.to_json(
        F.struct("channel", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("date"), F.col("message_id"), "text", "views"), {"ignoreNullFields": "false"}
    )
    rows = known.select("*", payload.alias("_j"))
    key = F.concat(F.lit("tg:"), "channel", F.lit(":"), F.col("message_id").cast("string"))
    return _lake_row(rows, fetched_at, scope, vacancy_id=key, source=F.lit("telegram"), posted_at=F.col("date"), content_hash=hash_of_json(F.col("_j")), raw_json=_sorted_json(F.col("_j")))


def last_messages(messages: DataFrame, most: int) -> DataFrame:
    """Of each channel the `most` newest messages that have a text, by message id; a message delivered twice counts
    once. The ids are found first, so texts travel only for messages that stay."""
    from pyspark.sql import Window

    said = messages.where("text is not null and trim(text) <> '' and channel is not null and message_id is not null")
    ids = said.select("channel", "message_id").distinct()
    rank = F.row_number().over(Window.partitionBy("channel").orderBy(F.desc("message_id")))
    kept = ids.withColumn("_rank", rank).where(F.col("_rank") <= most).drop("_rank")
    return said.dropDuplicates(["channel", "message_id"]).join(kept, ["channel", "message_id"], "left_semi")
