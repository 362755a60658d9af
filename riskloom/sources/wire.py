"""The JSON wire format of transactions and alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.features import BILL_COLUMNS, PAID_COLUMNS, PAY_COLUMNS
from riskloom.session import compile_small_methods

# Wire fields by type. Each is accepted in lower case or under its alias.
INTEGER_FIELDS = ("sex", "education", "marriage", "age", *PAY_COLUMNS)
DOUBLE_FIELDS = ("limit_bal", *BILL_COLUMNS, *PAID_COLUMNS)
FIELD_ALIASES = {
    "transaction_id": "ID",
    **{n: n.upper() for n in (*DOUBLE_FIELDS[:1], *INTEGER_FIELDS, *DOUBLE_FIELDS[1:])},
}
_SQL_TYPES = {"transaction_id": "string", **dict.fromkeys(INTEGER_FIELDS, "int")}
# How Spark names the type of a JSON number that may be read as a double.
NUMBER_TYPES = r"(BIGINT|DECIMAL\(\d+,\d+\)|DOUBLE|FLOAT)"
# Fixed value: the accepted timestamp form, RFC 3339.
TIMESTAMP_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
)


def _document(text: Column) -> Column:
    """Parse exactly one JSON document, null if there is anything wrong or anything after it.

    Spark's parser stops at the end of the first value. Inside brackets, trailing text makes the
    array malformed or longer, except text that closes the bracket itself; only messages holding
    such a bracket are parsed a second time, inside braces, which no text can close both ways.
    """
    inside = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    braced = F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit("}")))
    return F.when(~F.contains(text, F.lit("]")) | braced.isNotNull(), inside)


def _once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Append a column that later filters read instead of working it out again.

    Spark pushes a filter below a projection by repeating the projected expression in it, and a
    parse is too dear to repeat. It does not push one below ``explode``.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))


def _typed() -> Column:
    """All fields of a message in one pass over it, by name; the second spelling only if the first leaves gaps.

    What does not have its type is null. Whether it may be is decided elsewhere.
    """

    def read(spelling: dict[str, str], more: str = "") -> str:
        fields = ", ".join(f"`{spelling[n]}`: {_SQL_TYPES.get(n, 'double')}" for n in FIELD_ALIASES)
        return f"try_variant_get(doc, '$[0]', 'struct<{fields}{more}>')"

    def named(source: str, spelling: dict[str, str]) -> str:
        return ", ".join(f"{source}.`{spelling[n]}` as {n}" for n in FIELD_ALIASES)

    plain = {n: n for n in FIELD_ALIASES}
    gaps = " or ".join(f"p.{n} is null" for n in FIELD_ALIASES)
    both = ", ".join(f"coalesce(p.{n}, u.`{FIELD_ALIASES[n]}`) as {n}" for n in FIELD_ALIASES)
    upper = read(FIELD_ALIASES)
    # Going through one-element arrays gives each pass a name, so that none is repeated per field.
    return F.expr(
        f"transform(array({read(plain, ', timestamp: string')}), p -> "
        f"transform(array(case when p is null or {gaps} then {upper} end), u -> "
        f"struct({both}, p.timestamp as timestamp))[0])[0]"
    )


def _field_kinds() -> Column:
    """Name, alias and expected kind of each required field, in wire order."""
    kinds = dict.fromkeys(INTEGER_FIELDS, "int") | dict.fromkeys(DOUBLE_FIELDS, "double")
    fields = [
        f"named_struct('name', '{name}', 'alias', '{alias}', 'kind', '{kinds.get(name, 'string')}')"
        for name, alias in FIELD_ALIASES.items()
    ]
    return F.expr(f"array({', '.join(fields)})")


def _is_valid(field: Column, given: Column) -> Column:
    """A required field is given in one spelling only, with the right JSON type, and in range."""
    plain = F.try_element_at(given, field["name"])
    upper = F.try_element_at(given, field["alias"])
    value = F.coalesce(plain, upper)
    json_type = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "double")
    typed = (
        F.when(field["kind"] == "string", json_type == "STRING")
        .when(
            field["kind"] == "int",
            (json_type == "BIGINT") & F.try_variant_get(value, "$", "int").isNotNull(),
        )
        .otherwise(json_type.rlike(f"^{NUMBER_TYPES}") & (F.abs(number) < F.lit(float("inf"))))
    )
    return F.coalesce((plain.isNull() != upper.isNull()) & typed, F.lit(False))


def _time_is_valid(given: Column) -> Column:
    """A missing timestamp is fine; one that is there must be RFC 3339 text."""
    value = F.try_element_at(given, F.lit("timestamp"))
    text = F.try_variant_get(value, "$", "string")
    good = (F.schema_of_variant(value) == "STRING") & _is_time(text)
    return value.isNull() | F.coalesce(good, F.lit(False))


def _is_time(text: Column) -> Column:
    return text.rlike(TIMESTAMP_PATTERN) & F.try_to_timestamp(F.upper(text)).isNotNull()


def _fault() -> Column:
    """Name of the first field at fault, found by looking at every field of the message."""

    def first_fault(given: Column) -> Column:
        faults = F.filter(_field_kinds(), lambda f: ~_is_valid(f, given))
        return F.when(F.size(faults) > 0, F.try_element_at(faults, F.lit(1))["name"]).when(
            ~_time_is_valid(given), "timestamp"
        )

    # Going through a one-element array opens the message once, not once per field.
    opened = F.array(F.expr("try_variant_get(doc, '$[0]', 'map<string,variant>')"))
    return F.try_element_at(F.transform(opened, first_fault), F.lit(1))


def _usual_shape(upper: bool) -> str:
    """Pattern of a message's type when it has all fields in one spelling and no others."""
    kinds = {n: "BIGINT" for n in INTEGER_FIELDS} | {n: NUMBER_TYPES for n in DOUBLE_FIELDS}
    fields = {
        (alias if upper else name): f": {kinds.get(name, 'STRING')}" for name, alias in FIELD_ALIASES.items()
    }
    listed = [f"{name}{kind}" for name, kind in sorted(fields.items())]
    at = sum(name < "timestamp" for name in fields)
    before, after = ", ".join(listed[:at]), ", ".join(listed[at:])
    time = "(, timestamp: STRING)?"
    return f"OBJECT<{before}{time}{', ' if after else ''}{after}>"


# An object of plain pairs and nothing else: no nesting, no escapes, no null or true, nothing after it. Possessive, so linear.
_FLAT = r'^\s*+\{(?:\s*+"\w++":\s*+(?:"[^"\\]*+"|[-0-9][-+.0-9eE]*+)\s*+(?:,(?=\s*+")|(?=\})))++\}\s*+\z'


def _typed_parse(text: Column) -> Column:
    """All fields from one typed parse of a message in the spelling that it seems to use; null where one does not fit."""

    def schema(spelling: dict[str, str]) -> str:
        return ", ".join(f"{spelling[n]} {_SQL_TYPES.get(n, 'double')}" for n in FIELD_ALIASES) + ", timestamp string"

    plain = schema({n: n for n in FIELD_ALIASES})
    upper = F.from_json(text, schema(FIELD_ALIASES)).cast(f"struct<{plain.replace(' ', ':').replace(',:', ',')}>")
    return F.when(_is_upper(text), upper).otherwise(F.from_json(text, plain))


def _verdict(text: Column, fast: str) -> Column:
    """(sure, fault): whether the typed parse tells all about a message, and then the first field at fault.

    An ordinary message is a flat object in which every field was found, finite and of its type, and which has as many
    keys as fields were found: so each comes once, in one spelling, and there are no others. A flat object that is
    not ordinary is judged by its keys, if none repeats and none is of the other spelling. A typed parse reads a
    number as text too, so the quotes of the texts are looked for. The rest goes the long way, whatever it is.
    """
    field = lambda n: F.col(f"{fast}.{n}")
    quoted = lambda *names: reduce(
        lambda a, b: a | b, [F.contains(text, F.lit(f'"{n}":{blank}"')) for n in names for blank in ("", " ")]
    )
    good = {n: field(n).isNotNull() for n in FIELD_ALIASES}
    good["transaction_id"] &= quoted("transaction_id", FIELD_ALIASES["transaction_id"])
    for n in DOUBLE_FIELDS:
        good[n] &= F.abs(field(n)) < F.lit(float("inf"))
    time = field("timestamp")
    timed = quoted("timestamp") & _is_time(time)
    flat = text.rlike(_FLAT)
    count = F.octet_length(text) - F.octet_length(F.replace(text, F.lit('":'), F.lit('"')))
    wanted = F.lit(len(FIELD_ALIASES)) + time.isNotNull().cast("int")
    ordinary = (count == wanted) & reduce(lambda a, b: a & b, good.values()) & (time.isNull() | timed) & flat

    keys = F.regexp_extract_all(text, F.lit(r'"(\w++)":'))
    other = F.when(_is_upper(text), F.array(*map(F.lit, FIELD_ALIASES))).otherwise(F.array(*map(F.lit, FIELD_ALIASES.values())))
    told = flat & (F.size(F.array_distinct(keys)) == F.size(keys)) & ~F.arrays_overlap(keys, other)
    faults = [F.when(~F.coalesce(ok, F.lit(False)), n) for n, ok in good.items()]
    late = F.when(F.array_contains(keys, "timestamp") & ~F.coalesce(timed, F.lit(False)), "timestamp")
    verdict = lambda sure, fault: F.struct(F.lit(sure).alias("sure"), fault.cast("string").alias("fault"))
    return (
        F.when(ordinary, verdict(True, F.lit(None)))
        .when(told, verdict(True, F.coalesce(*faults, late)))
        .otherwise(verdict(False, F.lit(None)))
    )


def _is_upper(text: Column) -> Column:
    return F.contains(text, F.lit(f'"{FIELD_ALIASES["limit_bal"]}"'))


def _is_usual() -> Column:
    """A quick test that good messages pass: usual shape, numbers in range, valid time.

    Whatever does not pass is looked at field by field, so this decides speed, not the outcome.
    """
    shape = F.col("kind").rlike(f"^({_usual_shape(False)}|{_usual_shape(True)})$")
    whole = " and ".join(f"typed.{n} is not null" for n in INTEGER_FIELDS)
    finite = " and ".join(f"abs(typed.{n}) < double('infinity')" for n in DOUBLE_FIELDS)
    # A timestamp that is there but no text does not have the usual shape.
    time = F.col("typed.timestamp").isNull() | F.coalesce(_is_time(F.col("typed.timestamp")), F.lit(False))
    return F.coalesce(shape & F.expr(whole) & F.expr(finite) & time, F.lit(False))


def decode_transactions(messages: DataFrame, column: str = "value") -> DataFrame:
    """Typed transaction columns plus ``reject_reason``, null on accepted messages.

    Every other column of ``messages`` is kept. A message is rejected when it is not one JSON
    object, misses a field, gives it in both spellings or twice, or with a wrong JSON type
    (``30.0`` is no integer, a number is no id). Unknown fields are ignored. A missing timestamp
    becomes the current time; one that is present must be valid. The reason is ``malformed`` or the
    first field at fault.

    Flat messages take one typed parse and a scan of their text; only the others are opened as variants. Fields of
    a rejected message may be null.
    """
    compile_small_methods(messages.sparkSession)
    text = F.col(column)
    read = _once(messages, "_fast", _typed_parse(text))
    tried = _once(read, "_verdict", _verdict(text, "_fast"))
    sure = F.col("_verdict.sure")
    parsed = _once(tried, "doc", F.when(~sure, _document(text)))
    kind = F.expr("schema_of_variant(try_variant_get(doc, '$[0]', 'variant'))")
    is_single = F.expr("try_variant_get(doc, '$[1]', 'variant') is null")
    opened = _once(_once(parsed, "kind", F.when(~sure & is_single, kind)), "typed", F.when(~sure, _typed()))
    is_object = F.coalesce(F.col("kind").startswith("OBJECT"), F.lit(False))
    reason = F.when(sure, F.col("_verdict.fault")).when(~is_object, "malformed").when(~_is_usual(), _fault())
    found = {n: F.when(sure, F.col(f"_fast.{n}")).otherwise(F.col(f"typed.{n}")) for n in (*FIELD_ALIASES, "timestamp")}
    time = F.try_to_timestamp(F.upper(found.pop("timestamp")))
    names = {*FIELD_ALIASES, "timestamp"}
    return opened.select(
        *[F.col(c) for c in messages.columns if c.lower() not in names],
        *[column.alias(n) for n, column in found.items()],
        F.coalesce(time, F.current_timestamp()).alias("timestamp"),
        reason.alias("reject_reason"),
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(decoded: DataFrame, column: str = "value") -> DataFrame:
    """Message and reason of everything that could not be decoded."""
    return decoded.filter(F.col("reject_reason").isNotNull()).select(column, "reject_reason")


def wire_fields(key: str) -> list[Column]:
    """A labelled table row as wire fields: cast, renamed, in wire order."""
    return [
        F.col(key).cast("long").cast("string").alias("transaction_id"),
        *[
            F.expr(f"cast({n} as {'int' if n in INTEGER_FIELDS else 'double'}) as {n}")
            for n in FIELD_ALIASES
            if n != "transaction_id"
        ],
    ]


def to_transaction_json(key: str, timestamp: Column | None = None) -> Column:
    """JSON text of one labelled row; without a timestamp the receiver fills it in."""
    fields = wire_fields(key)
    if timestamp is not None:
        fields.append(timestamp.alias("timestamp"))
    return F.to_json(F.struct(*fields))


def to_alert_json(alerts: DataFrame) -> DataFrame:
    """Alerts as key and JSON value, ready for a message sink."""
    return alerts.select(
        F.col("transaction_id").alias("key"), F.to_json(F.struct(*alerts.columns)).alias("value")
    )
