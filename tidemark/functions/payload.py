"""Getters for JSON payloads: value text, '' for missing, '_' for malformed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the payload document and its result marks -------------------
PAYLOAD_SCHEMA = (
    "document struct<"
    "header: struct<icid: string, start: string>, "
    "dimensions: struct<mo: struct<imsi: string>, mt: struct<imsi: string>>>, "
    "_malformed string"
)
GETTERS = {
    "icid": "header.icid",
    "start": "header.start",
    "mo_imsi": "dimensions.mo.imsi",
    "mt_imsi": "dimensions.mt.imsi",
}
MISSING = ""
MALFORMED = "_"
WHITESPACE = " \t\r\n"
OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_malformed",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}
# --------------------------------------------------------------------------------


def _text(payload: Column) -> Column:
    return F.btrim(payload, F.lit(WHITESPACE))


def _member(payload: Column) -> Column:
    """The text as the only member of an object."""
    return F.concat(F.lit('{"document":'), payload, F.lit("}"))


def _one_element(payload: Column) -> Column:
    """Whether the text is one element of an array.

    Spark's parsers stop at the end of the first value. What follows a payload shows
    when it is put into brackets: text or a second value there is no longer one
    element. A payload that closes the bracket itself breaks ``_member`` instead.
    """
    count = F.json_array_length(F.concat(F.lit("["), payload, F.lit("]")))
    return F.coalesce(count == 1, F.lit(False))


def _document(payload: Column) -> Column:
    """The typed parse, for texts that can be an object (a failed parse is expensive)."""
    parsed = F.from_json(_member(payload), PAYLOAD_SCHEMA, OPTIONS)
    return F.when(_text(payload).startswith("{") & _one_element(payload), parsed)


def _mark(payload: Column, document: Column) -> Column:
    """'' for no document, '_' for a text that is no JSON object, null for an object.

    The typed parse also rejects a valid object whose members have other types
    (``{"header": 5}``), so what it rejects, and only that, is parsed again.
    """
    blank = payload.isNull() | _text(payload).isin("", "null")
    return (
        F.when(document.isNotNull() & document["_malformed"].isNull(), F.lit(None).cast("string"))
        .when(blank, F.lit(MISSING))
        .when(document.isNull() | ~_closed(payload), F.lit(MALFORMED))
    )


def _closed(payload: Column) -> Column:
    """Whether the text is a whole member of an object; its content is skipped, not kept."""
    return F.from_json(_member(payload), "_malformed string", OPTIONS)["_malformed"].isNull()


def is_valid_json(payload: Column) -> Column:
    """Whether the text is one JSON value of any kind; false for empty and null.

    Repeated keys are valid, and texts of any length; nesting beyond Spark's limit of
    1,000 levels is not.
    """
    return payload.isNotNull() & _one_element(payload) & _closed(payload)


def payload_fields(payload: Column, names: tuple[str, ...] = tuple(GETTERS)) -> Column:
    """Struct of the named getters over one parse of the payload.

    ``transform`` over a one-element array gives a value a name inside an expression:
    the document is parsed once and judged once, however many getters there are.
    """

    def judged(document: Column) -> Column:
        return F.struct(document.alias("document"), _mark(payload, document).alias("mark"))

    def getters(parsed: Column) -> Column:
        document, mark = parsed["document"], parsed["mark"]
        return F.struct(
            *[
                F.coalesce(mark, _path(document, f"document.{GETTERS[name]}"), F.lit(MISSING)).alias(name)
                for name in names
            ]
        )

    once = F.transform(F.array(_document(payload)), judged)
    return F.get(F.transform(once, getters), F.lit(0))


def _path(document: Column, path: str) -> Column:
    for part in path.split("."):
        document = document[part]
    return document


def icid(payload: Column) -> Column:
    return payload_fields(payload, ("icid",))["icid"]


def start(payload: Column) -> Column:
    return payload_fields(payload, ("start",))["start"]


def mo_imsi(payload: Column) -> Column:
    return payload_fields(payload, ("mo_imsi",))["mo_imsi"]


def mt_imsi(payload: Column) -> Column:
    return payload_fields(payload, ("mt_imsi",))["mt_imsi"]
