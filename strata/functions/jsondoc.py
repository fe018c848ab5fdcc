"""Functions over JSON documents whose shape is not known beforehand.

Documents may be of any size and repeat keys, of which the last counts. Strings that start like a list
or an object are marked first: read as text, each value then shows by its first character what it is.
Nesting beyond a thousand levels is not read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The keys under which a document may hold its records, in order of preference.
COUNT_KEYS = ("data", "records", "items", "results", "hourly")
ROW_KEYS = ("data", "records", "items")

END, MARK = uuid.uuid4().hex, uuid.uuid4().hex

# First characters by which a string could be taken for a list or an object, spelt out or escaped, and
# further for null, false or a number of zero.
NESTED = ("[", "{", "\\")
BLANK = ("n", "f", "0", "-")

STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "maxStringLen": str(2**31 - 1)}


def once(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is worked out a single time, however often ``fn`` names it."""
    return F.transform(F.array(value), fn)[0]


def _marked(text: Column, starts: tuple[str, ...]) -> Column:
    """In valid JSON a quote stands before such a character only where a string starts, or within one."""
    for start in starts:
        text = F.replace(text, F.lit(f'"{start}'), F.lit(f'"{MARK}{start}'))
    return text


def _unmarked(text: Column) -> Column:
    return F.replace(text, F.lit(MARK), F.lit(""))


def _listed(text: Column) -> Column:
    return F.from_json(text, "array<string>", STRICT)


def _members(text: Column) -> Column:
    """Keys and values of an object in order, repeated keys included."""
    return F.map_entries(F.from_json(text, "map<string,string>", STRICT))


def document(json_col: Column | str, starts: tuple[str, ...] = NESTED) -> Column:
    """The marked text of the document; null unless the whole text is one JSON value.

    The parser stops after the first value it finds, so the text is read as the first of two list
    items. Text that ends early, or goes on after its value, does not leave the second one in place.
    """
    text = F.col(json_col) if isinstance(json_col, str) else json_col
    listed = _listed(F.concat(F.lit("["), _marked(text, starts), F.lit(f',"{END}"]')))
    whole = lambda found: (F.size(found) == 2) & (F.get(found, F.lit(1)) == END)
    return once(listed, lambda found: F.when(whole(found), F.coalesce(F.get(found, F.lit(0)), F.lit("null"))))


def _is_list(text: Column) -> Column:
    return text.startswith("[")


def _is_object(text: Column) -> Column:
    return text.startswith("{")


def _last(members: Column, key: str) -> Column:
    return F.try_element_at(F.filter(members, lambda m: m["key"].isin(key, MARK + key)), F.lit(-1))["value"]


def _length(text: Column) -> Column:
    """Length of a list; null for all else."""
    return F.when(_is_list(text), F.json_array_length(text).cast("bigint"))


def _total_length(members: Column) -> Column:
    """Summed length of those values of an object that are lists."""
    placed = F.array_sort(
        F.transform(members, lambda m, i: F.struct(_unmarked(m["key"]).alias("key"), i.alias("i"), _length(m["value"]).alias("n")))
    )
    last = lambda found: F.filter(found, lambda m, i: ~F.get(found, i + 1)["key"].eqNullSafe(m["key"]))
    zero = F.lit(0).cast("bigint")
    return F.aggregate(once(placed, last), zero, lambda total, m: total + F.coalesce(m["n"], zero))


def _held(text: Column) -> Column:
    return F.when(_is_list(text), _length(text)).when(_is_object(text), _total_length(_members(text)))


def record_count(json_col: Column | str) -> Column:
    """Best-effort number of records in a JSON text; null when the text is not JSON."""
    single = F.lit(1).cast("bigint")

    def inside(members: Column) -> Column:
        return F.coalesce(*[once(_last(members, key), _held) for key in COUNT_KEYS])

    def counted(doc: Column) -> Column:
        found = F.when(_is_list(doc), _length(doc)).when(_is_object(doc), once(_members(doc), inside))
        return F.when(doc.isNotNull(), F.coalesce(found, single))

    return once(document(json_col), counted)


def top_keys(json_col: Column | str) -> Column:
    """The keys of a document that is an object; null for all else."""
    keys = lambda doc: F.when(_is_object(doc), F.transform(_members(doc), lambda m: _unmarked(m["key"])))
    return once(document(json_col), keys)


def _filled(text: Column) -> Column:
    """False for null, false, zero and empty text, lists and objects."""
    scalar = ~text.isin("null", "false", "") & ~text.rlike(r"^-?0(\.0*)?([eE].*)?$")
    found = F.when(_is_list(text), _length(text) > 0).when(_is_object(text), F.size(_members(text)) > 0).otherwise(scalar)
    return F.coalesce(found, F.lit(False))


def unwrap_rows(df: DataFrame, json_col: str, row_schema: str) -> DataFrame:
    """One row per record of each document, read as ``row_schema`` (DDL) into column ``row``.

    A list holds its records; an object holds them under the first filled key of ``ROW_KEYS`` or is
    itself the record. Bare values and text that is not JSON give no rows. Values are cast to the
    schema's types; in a record that repeats a key they must have them.
    """

    def inner(doc: Column) -> Column:
        held = lambda members: F.coalesce(*[once(_last(members, k), lambda m: F.when(_filled(m), m)) for k in ROW_KEYS])
        return F.when(_is_list(doc), doc).when(_is_object(doc), F.coalesce(once(_members(doc), held), doc))

    def records(found: Column) -> Column:
        listed = F.transform(_listed(found), lambda r: F.coalesce(r, F.lit("null")))
        return F.when(_is_list(found), listed).when(found.isNotNull(), F.array(found))

    type_ = f"struct<{row_schema}>"

    def read(record: Column) -> Column:
        value = F.try_parse_json(record)
        repeated = F.when(value.isNull() & _is_object(record), F.from_json(record, type_, STRICT))
        return F.coalesce(F.try_variant_get(value, "$", type_), repeated)

    found = df.withColumn("_row", F.explode(once(once(document(json_col, NESTED + BLANK), inner), records)))
    return found.withColumn("row", once(_unmarked(F.col("_row")), read)).drop("_row")


def parse(json_col: Column | str) -> Column:
    """The document as a variant; null unless the whole text is one JSON value that a variant can hold.

    That leaves out repeated keys and text beyond the variant's size limit.
    """
    text = F.col(json_col) if isinstance(json_col, str) else json_col
    return once(text, lambda t: F.when(document(t).isNotNull(), F.try_parse_json(t)))


def extract_typed(df: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Add ``{alias: (path, type)}`` from nested columns; text that does not fit the type gives null."""
    return df.withColumns({alias: F.col(path).try_cast(type_) for alias, (path, type_) in fields.items()})


def extract_json(df: DataFrame, json_col: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Add ``{alias: (json path, type)}`` from a JSON text column; what is absent or does not fit gives null.

    Documents that a variant cannot hold, as they repeat a key or are too large, are read along the path
    instead: of a repeated key the last value counts.
    """
    text = F.col(json_col)
    whole = document(text).isNotNull()

    def typed(path: str, type_: str) -> Column:
        held = F.try_variant_get(F.col("_doc"), path, type_)
        return F.when(F.col("_doc").isNull() & F.col("_whole"), along_path(text, path).try_cast(type_)).otherwise(held)

    parsed = df.withColumns({"_doc": parse(json_col), "_whole": whole})
    return parsed.withColumns({alias: typed(path, type_) for alias, (path, type_) in fields.items()}).drop("_doc", "_whole")


PATH_STEP = re.compile(r"\.([^.\[\]]+)|\['([^']+)'\]|\[(\d+)\]")


def along_path(text: Column, path: str) -> Column:
    """The value at a path of a JSON text, as text, of any size and with repeated keys.

    Of a repeated key the last value counts; on a path through a list the first one does.
    """
    steps = PATH_STEP.findall(path)
    if "".join(m.group() for m in PATH_STEP.finditer(path)) != path.removeprefix("$"):
        raise ValueError(f"not a path of names and places: {path}")
    if any(place for _, _, place in steps) or not steps:
        return F.get_json_object(text, path)
    names, type_ = [dotted or quoted for dotted, quoted, _ in steps], "string"
    for name in reversed(names):
        type_ = f"struct<`{name.replace('`', '``')}`: {type_}>"
    value = F.from_json(text, type_, {"mode": "PERMISSIVE"})
    for name in names:
        value = value.getField(name)
    return value


def wrap_envelope(
    df: DataFrame, payload: str, source: Column, execution_date: Column, ingested_at: Column
) -> DataFrame:
    """Wrap landed payload text: adds ``record_count``, ``status`` and the ``envelope`` text.

    The payload stays as landed, but for line breaks between tokens: an envelope is one line, so that
    the raw files can be split. Text that is not JSON has status ``failed`` and no envelope.
    """
    head = F.to_json(
        F.struct(
            source.cast("string").alias("source"),
            ingested_at.cast("string").alias("ingested_at"),
            execution_date.cast("string").alias("execution_date"),
            F.col("record_count"),
        )
    )
    body = F.regexp_replace(payload, r"[\r\n]+", " ")
    text = F.concat(F.expr("substring(_head, 1, length(_head) - 1)"), F.lit(',"data":'), body, F.lit("}"))
    return (
        df.withColumn("record_count", record_count(payload))
        .withColumn("_head", F.when(F.col("record_count").isNotNull(), head))
        .withColumn("envelope", text)
        .withColumn("status", F.when(F.col("record_count").isNull(), "failed").otherwise("success"))
        .drop("_head")
    )
