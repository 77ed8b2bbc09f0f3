"""Schemas: the raw status fields that are read, and the parsed-status table."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()


def _f(name, dtype):
    return T.StructField(name, dtype, True)


MENTION = T.StructType([_f("id_str", S), _f("screen_name", S), _f("indices", T.ArrayType(T.IntegerType()))])
URL = T.StructType([_f("expanded_url", S), _f("unwound", T.StructType([_f("url", S)]))])
MEDIA = T.StructType([_f("type", S), _f("media_url", S), _f("expanded_url", S)])
ENTITIES = T.StructType([_f("user_mentions", T.ArrayType(MENTION)), _f("urls", T.ArrayType(URL))])
EXT_ENTITIES = T.StructType([_f("media", T.ArrayType(MEDIA))])
USER = T.StructType([
    _f("id_str", S), _f("screen_name", S), _f("name", S), _f("description", S), _f("location", S),
    _f("timezone", S), _f("created_at", S), _f("followers_count", L), _f("friends_count", L),
    _f("statuses_count", L), _f("verified", T.BooleanType())])
EXTENDED = T.StructType([_f("full_text", S), _f("entities", ENTITIES), _f("extended_entities", EXT_ENTITIES)])
COORDS = T.StructType([_f("coordinates", T.ArrayType(T.DoubleType()))])
PLACE = T.StructType([
    _f("country_code", S), _f("place_type", S),
    _f("bounding_box", T.StructType([_f("coordinates", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))]))])
# ids of a status embedded two levels deep (only these are read from it)
REF = T.StructType([_f("id_str", S), _f("user", T.StructType([_f("id_str", S)]))])

_STATUS_FIELDS = [
    _f("id", L), _f("id_str", S), _f("text", S), _f("created_at", S), _f("lang", S),
    _f("in_reply_to_status_id_str", S), _f("in_reply_to_user_id_str", S),
    _f("user", USER), _f("entities", ENTITIES), _f("extended_tweet", EXTENDED),
    _f("extended_entities", EXT_ENTITIES), _f("coordinates", COORDS), _f("place", PLACE),
]
# an embedded status: full fields, its own embedded statuses as ids only
EMBEDDED_STATUS = T.StructType(_STATUS_FIELDS + [_f("quoted_status", REF), _f("retweeted_status", REF)])
RAW_STATUS = T.StructType(_STATUS_FIELDS + [_f("quoted_status", EMBEDDED_STATUS),
                                            _f("retweeted_status", EMBEDDED_STATUS)])

# Parsed statuses (dots of the original names become underscores)
PARSED = T.StructType([
    _f("id", S), _f("text", S), _f("in_reply_to_status_id", S), _f("in_reply_to_user_id", S),
    _f("quoted_user_id", S), _f("quoted_status_id", S), _f("retweeted_user_id", S), _f("retweeted_status_id", S),
    _f("created_at", T.TimestampType()), _f("entities_user_mentions", T.ArrayType(S)),
    _f("user_id", S), _f("user_screen_name", S), _f("user_name", S), _f("user_description", S),
    _f("user_timezone", S), _f("user_location", S), _f("user_num_followers", L), _f("user_num_following", L),
    _f("user_created_at", T.TimestampType()), _f("user_statuses_count", L), _f("user_is_verified", T.BooleanType()),
    _f("lang", S), _f("token_count", T.IntegerType()), _f("is_retweet", T.BooleanType()),
    _f("has_quote", T.BooleanType()), _f("is_reply", T.BooleanType()), _f("contains_keywords", T.BooleanType()),
    _f("longitude", T.DoubleType()), _f("latitude", T.DoubleType()), _f("country_code", S),
    _f("geoname_id", S), _f("location_type", S), _f("geo_type", T.IntegerType()), _f("region", S),
    _f("subregion", S),
    _f("num_replies", L), _f("num_quotes", L), _f("num_retweets", L),
])


def get_dtypes(usecols=None) -> T.StructType:
    """The parsed schema, optionally restricted to ``usecols`` (in that order)."""
    if usecols is None:
        return PARSED
    by_name = {f.name: f for f in PARSED.fields}
    missing = [c for c in usecols if c not in by_name]
    if missing:
        raise KeyError(f"unknown parsed columns {missing}")
    return T.StructType([by_name[c] for c in usecols])
