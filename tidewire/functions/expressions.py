"""Per-message expressions: the columns they see, and ``text${!expression}`` templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.binding import bind
from .maps import empty_map
from .time import col


def parse_json_object(text: Column | str) -> Column:
    """JSON object as VARIANT; anything else that is not null gives an empty object, never an error."""
    source = col(text).cast("string")
    is_object = source.rlike(r"^[ \t\r\n]*\{")
    parsed = F.coalesce(F.try_parse_json(F.when(is_object, source)), F.parse_json(F.lit("{}")))
    return F.when(source.isNotNull(), parsed)


def message_context(
    df: DataFrame, raw: str = "raw", metadata: str = "metadata", parse_once: bool = False
) -> DataFrame:
    """Add ``content``, ``json`` and ``metadata``, the columns a template can refer to.

    A message whose payload could not be read (null) has neither content nor json; its metadata stays. JSON is parsed
    where it is used, and not at all if it is not; with ``parse_once`` it is always parsed, but just once, which pays
    when several expressions or filters look into it.
    """
    known = F.coalesce(F.col(metadata), empty_map()) if metadata in df.columns else empty_map()
    content = F.col(raw).cast("string")
    out = df.withColumns({"content": content, "metadata": known})
    json = parse_json_object(content)
    if parse_once:
        return bind(out, "_json", json).drop("json").withColumnRenamed("_json", "json")
    return out.withColumn("json", json)


def split_template(template: str) -> list[tuple[str, str]]:
    """Cut a template into ``("text", ...)`` and ``("sql", ...)`` pieces.

    An expression ends at the brace that balances its opening one; braces inside quotes do not count.
    """
    pieces: list[tuple[str, str]] = []
    at = 0
    while at < len(template):
        opening = template.find("${!", at)
        if opening < 0:
            pieces.append(("text", template[at:]))
            break
        if opening > at:
            pieces.append(("text", template[at:opening]))
        closing = _closing_brace(template, opening + 3)
        pieces.append(("sql", template[opening + 3:closing]))
        at = closing + 1
    return pieces


def _closing_brace(template: str, start: int) -> int:
    depth, quote = 1, None
    for i in range(start, len(template)):
        ch = template[i]
        if quote:
            quote = None if ch == quote else quote
        elif ch in "'\"`":
            quote = ch
        elif ch in "{}":
            depth += 1 if ch == "{" else -1
            if depth == 0:
                return i
    raise ValueError(f"unclosed expression in template: {template!r}")


def render_strict(template: str) -> Column:
    """``struct(value, error)``: a null piece (a missing key, a failed ``try_`` function) is an error that names the
    expression, and there is no value then. For ``error`` columns of the publish policies."""
    sql = [text for kind, text in split_template(template) if kind == "sql"]
    failed = [F.when(F.expr(text).isNull(), F.lit(f"no value for {text}")) for text in sql]
    error = F.coalesce(*failed, F.lit(None).cast("string"))
    return F.struct(F.when(error.isNull(), render_template(template)).alias("value"), error.alias("error"))


def render_template(template: str) -> Column:
    """String column for a template whose expressions are Spark SQL over the message's columns.

    A null expression renders as the empty string.
    """
    pieces = [
        F.lit(text) if kind == "text" else F.coalesce(F.expr(text).cast("string"), F.lit(""))
        for kind, text in split_template(template)
    ]
    return F.concat(*pieces) if pieces else F.lit("")
