"""Typed reading of JSON with the tolerance of the wire format.

Scalars are coerced (a quoted number is a number, a fraction is cut to an
integer, any scalar is a string); a value that cannot be coerced makes the whole
document unusable.

A :class:`Reader` reads a document once, with integers and booleans as text, and
casts that text to the real types.  If nothing was lost, casting back gives the
same text and no text looks like a container, which is the normal case, the
document is sound.  Only an odd document is parsed again as a variant, checked
value by value, and read from there.  Where all that is odd lies in lists, only
those elements that lost something are checked.

The expressions are generated as SQL text from the type: one text per reader is
much cheaper to build than thousands of Column calls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallkeeper.schemas import ARRAY_READS_AS_NULL, CHECKED_AS, CHECKED_TYPES, OPAQUE

# Texts read as a missing scalar, and texts read as a boolean.
EMPTY_TEXTS = ("", "null")
BOOLEAN_TEXTS = ("true", "True", "TRUE", "false", "False", "FALSE")

SOUND, ODD, BAD = 0, 1, 2

# Only standard JSON: no single quotes, no bare NaN or Infinity.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
_VARIANTS_BY_NAME = "map<string,variant>"
_CORRUPT = "_unread"
_LIKE_CONTAINER = "coalesce(substring({0}, 1, 1) in ('{{', '['), false)"


def parse(text: Column) -> Column:
    """JSON text to variant; null when it is not JSON."""
    return F.try_parse_json(text)


def read(document: Column, path: str, dtype: T.DataType) -> Column:
    """Typed value at ``path``; parts that do not fit are null."""
    return F.try_variant_get(document, path, dtype.simpleString())


def present(document: str, path: str) -> str:
    """SQL: ``path`` exists and is not JSON null."""
    return f"coalesce({_kind_of(document, path)} <> 'VOID', false)"


def _quoted(texts) -> str:
    return ", ".join("'" + t + "'" for t in texts)


def _node(document: str, path: str) -> str:
    return f"try_variant_get({document}, '{path}', 'variant')"


def _kind_of(document: str, path: str) -> str:
    """SQL: JSON kind, such as BIGINT, STRING or OBJECT<..>."""
    return f"schema_of_variant({_node(document, path)})"


def _any(conditions: list[str]) -> str:
    return "(" + " or ".join(conditions) + ")" if conditions else "false"


def _is_real(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def _is_opaque(field: T.StructField) -> bool:
    return bool(field.metadata.get(OPAQUE))


def _checked_as(field: T.StructField) -> T.StructType | None:
    """Type that an opaque field's value is checked against, though it is kept as text."""
    return CHECKED_TYPES.get(field.metadata.get(CHECKED_AS))


class Reader:
    """Reads JSON documents of one object type."""

    def __init__(self, dtype: T.StructType):
        self.dtype = dtype
        self.loose_type = _loose(dtype)

    def read(self, df: DataFrame, text: str, into: str) -> DataFrame:
        """Adds ``into`` (the typed document), ``{into}_fit`` and ``{into}_variant``.

        The fit is sound, odd (usable) or bad, and null where the text is no
        JSON object.  The variant is only there when the document is not sound.
        """
        loose, typed, back, plain, sound = (f"{into}_{part}" for part in ("loose", "typed", "back", "plain", "sound"))
        fit, variant = f"{into}_fit", f"{into}_variant"
        schema = T.StructType([*self.loose_type.fields, T.StructField(_CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, **_STRICT}
        root = "named_struct(" + ", ".join(f"'{f}', {loose}.`{f}`" for f in self.loose_type.names) + ")"
        steps = df.withColumn(loose, F.from_json(F.col(text), schema, options))
        steps = steps.withColumn(typed, F.expr(f"try_cast({root} as {self.dtype.simpleString()})"))
        steps = steps.withColumn(back, F.expr(f"cast({typed} as {self.loose_type.simpleString()})"))
        steps = steps.withColumn(
            plain,
            F.expr(f"{loose} is not null and {loose}.{_CORRUPT} is null and not {_holds_container_text(loose, self.dtype)}"),
        )
        steps = steps.withColumn(sound, F.expr(f"{plain} and {back} <=> {root}"))
        steps = steps.withColumn(variant, F.when(~F.col(sound), parse(F.col(text))))
        fits = (
            f"case when {sound} then {SOUND}{self._odd_elements(plain, loose, back, variant)}"
            f" when {_kind_of(variant, '$')} not like 'OBJECT%' then null"
            f" when {variant} is null then null when {misfit(variant, self.dtype)} then {BAD} else {ODD} end"
        )
        again = read(F.col(variant), "$", self.dtype)
        return steps.select(
            *df.columns,
            F.when(F.col(sound), F.col(typed)).otherwise(again).alias(into),
            F.expr(fits).alias(fit),
            variant,
        )

    def _odd_elements(self, plain: str, loose: str, back: str, variant: str) -> str:
        """SQL: case for documents that are sound but for elements of their lists, which alone are checked."""
        lists = [f for f in self.dtype.fields if isinstance(f.dataType, T.ArrayType)]
        if not lists:
            return ""
        rest = [f"{back}.`{f.name}` <=> {loose}.`{f.name}`" for f in self.dtype.fields if f not in lists]
        bad = []
        for f in lists:
            elements = f"try_variant_get({variant}, '$.{f.name}', 'array<variant>')"
            # Zipped, so that what is compared is worked out once for the list.
            lost = f"zip_with({back}.`{f.name}`, {loose}.`{f.name}`, (b, l) -> not (b <=> l))"
            odd = f"filter(zip_with({elements}, {lost}, (v, o) -> if(coalesce(o, true), v, null)), v -> v is not null)"
            bad.append(f"coalesce(exists({odd}, v -> {misfit('v', f.dataType.elementType, 1)}), false)")
        return f" when {' and '.join([plain, f'{variant} is not null', *rest])} then if({_any(bad)}, {BAD}, {ODD})"


def _loose(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_loose(dtype.elementType))
    return dtype if _is_real(dtype) else T.StringType()


def _holds_container_text(loose: str, dtype: T.DataType, depth: int = 0) -> str:
    """SQL: some text below ``loose`` starts like an object or a list."""
    if isinstance(dtype, T.ArrayType):
        element = f"e{depth}"
        inside = _holds_container_text(element, dtype.elementType, depth + 1)
        return "false" if inside == "false" else f"coalesce(exists({loose}, {element} -> {inside}), false)"
    if isinstance(dtype, T.StructType):
        texts, conditions = [], []
        for f in dtype.fields:
            field = f"{loose}.`{f.name}`"
            if isinstance(f.dataType, T.StringType):
                texts += [] if _is_opaque(f) else [field]
                if _checked_as(f):
                    conditions.append(f"({field} is not null and not {_is_sound_text(field, _checked_as(f), depth)})")
            elif isinstance(f.dataType, (T.StructType, T.ArrayType)):
                inside = _holds_container_text(field, f.dataType, depth)
                conditions += [] if inside == "false" else [f"({field} is not null and {inside})"]
        if texts:
            conditions.insert(0, f"exists(array({', '.join(texts)}), t -> {_LIKE_CONTAINER.format('t')})")
        return "(" + " or ".join(conditions) + ")" if conditions else "false"
    return _LIKE_CONTAINER.format(loose) if isinstance(dtype, T.StringType) else "false"


def _is_sound_text(text: str, dtype: T.StructType, depth: int) -> str:
    """SQL: the text of an object reads as ``dtype`` without loss, by the same rule as a whole document.

    Only the small text is read again, not the document around it.  What it holds of its own kind is
    text once more and is not looked at.
    """
    held, loose_type = f"t{depth}", _loose(dtype)
    schema = T.StructType([*loose_type.fields, T.StructField(_CORRUPT, T.StringType())]).simpleString()
    options = ", ".join(f"'{k}', '{v}'" for k, v in {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, **_STRICT}.items())
    root = "named_struct(" + ", ".join(f"'{f}', {held}.`{f}`" for f in loose_type.names) + ")"
    same = f"cast(try_cast({root} as {dtype.simpleString()}) as {loose_type.simpleString()}) <=> {root}"
    good = f"{held} is not null and {held}.{_CORRUPT} is null and {same} and not {_holds_container_text(held, _unchecked(dtype), depth + 1)}"
    # The reading is bound to a name once: an array of one.
    return f"exists(array(from_json({text}, '{schema}', map({options}))), {held} -> {good})"


def _unchecked(dtype: T.DataType) -> T.DataType:
    """The type without fields that are kept as text and checked."""
    if isinstance(dtype, T.StructType):
        return T.StructType(
            [T.StructField(f.name, _unchecked(f.dataType), True, f.metadata) for f in dtype.fields if not _checked_as(f)]
        )
    return T.ArrayType(_unchecked(dtype.elementType)) if isinstance(dtype, T.ArrayType) else dtype


def _kind_wanted(field: T.StructField) -> str:
    if isinstance(field.dataType, T.StructType):
        return "object or array" if field.metadata.get(ARRAY_READS_AS_NULL) else "object"
    return "array" if isinstance(field.dataType, T.ArrayType) else field.dataType.simpleString()


def _objects(path: str, dtype: T.StructType):
    """Every object reachable without passing an array: (path, type)."""
    yield path, dtype
    for f in dtype.fields:
        if isinstance(f.dataType, T.StructType):
            yield from _objects(f"{path}.{f.name}", f.dataType)


def misfit(value: str, dtype: T.DataType, depth: int = 0, inner_values: bool = True) -> str:
    """SQL: the variant ``value`` holds something ``dtype`` cannot take.

    The check of one scalar is written once and run over (name, wanted kind)
    lists, one per object.  ``inner_values``: opaque fields with a type of their
    own are checked too; inside of such a field they are not, so a type that
    holds itself is checked one level down.
    """
    kind = f"schema_of_variant({value})"
    given = f"{value} is not null and not is_variant_null({value})"
    if isinstance(dtype, T.ArrayType):
        inner = f"a{depth}"
        elements = f"try_variant_get({value}, '$', 'array<variant>')"
        found = f"exists({elements}, {inner} -> {misfit(inner, dtype.elementType, depth + 1, inner_values)})"
        return f"coalesce({given} and ({kind} not like 'ARRAY%' or {found}), false)"
    if not isinstance(dtype, T.StructType):
        return _scalar_misfit(f"struct({value} as v, {kind} as k, '{dtype.simpleString()}' as w)")

    checks, arrays = [], []
    for path, struct in _objects("$", dtype):
        fields = [f for f in struct.fields if not _is_opaque(f)]
        specs = ",".join(f"{f.name}:{_kind_wanted(f)}" for f in fields)
        checks.append(
            f"struct(try_variant_get({value}, '{path}', '{_VARIANTS_BY_NAME}') as vals,"
            f" map_entries(str_to_map('{specs}')) as specs)"
        )
        arrays += [
            misfit(_node(value, f"{path}.{f.name}"), f.dataType, depth + 1, inner_values)
            for f in fields
            if isinstance(f.dataType, T.ArrayType)
        ]
        # A text stands for such a value where a parsed document was written as JSON again.
        arrays += [
            f"({_kind_of(value, f'{path}.{f.name}')} <> 'STRING'"
            f" and {misfit(_node(value, f'{path}.{f.name}'), _checked_as(f), depth + 1, False)})"
            for f in struct.fields
            if inner_values and _checked_as(f)
        ]
    # Values present in an object, each with its kind, looked at once.
    values = "filter(transform(o.specs, s -> struct(try_element_at(o.vals, s.key) as v, s.value as w)), x -> x.v is not null)"
    kinds = f"transform({values}, x -> struct(x.v as v, schema_of_variant(x.v) as k, x.w as w))"
    fields_bad = f"exists(filter(array({', '.join(checks)}), o -> o.vals is not null), o -> exists({kinds}, f -> {_scalar_misfit('f')}))"
    return f"coalesce({given} and ({kind} not like 'OBJECT%' or {fields_bad} or {_any(arrays)}), false)"


def _scalar_misfit(f: str) -> str:
    """SQL: value ``f.v`` of JSON kind ``f.k`` cannot be read as ``f.w``."""
    text = f"try_variant_get({f}.v, '$', 'string')"

    def lost(dtype: str) -> str:
        return f"try_variant_get({f}.v, '$', '{dtype}') is null"

    is_object, is_array = f"{f}.k like 'OBJECT%'", f"{f}.k like 'ARRAY%'"
    return f"""
        case when {f}.k is null or {f}.k = 'VOID' then false
             when {f}.w = 'object' then not {is_object}
             when {f}.w = 'array' then not {is_array}
             when {f}.w = 'object or array' then not ({is_object} or {is_array})
             when {is_object} or {is_array} then true
             when {f}.w = 'string' then false
             when {f}.k = 'BOOLEAN' then {f}.w <> 'boolean'
             when {f}.k = 'STRING' and trim({text}) in ({_quoted(EMPTY_TEXTS)}) then false
             when {f}.w = 'boolean'
               then not ({f}.k = 'BIGINT' or ({f}.k = 'STRING' and {text} in ({_quoted(BOOLEAN_TEXTS)})))
             when {f}.w = 'int' then {lost('int')}
             when {f}.w = 'bigint' then {lost('bigint')}
             else {lost('double')} end"""
