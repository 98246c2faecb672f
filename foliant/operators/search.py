"""Predicates: condition lists, tag terms, keywords. Conditions are compiled to one column, so Catalyst pushes them down."""

from __future__ import annotations

import json
import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import creator_names, search_key, search_variants, year

#: What an operation asks of a value and its target, both folded. These also compare as numbers where both are such.
PLAIN = {"is": operator.eq, "contains": Column.contains, "beginsWith": Column.startswith, "endsWith": Column.endswith}
ORDERED = {"isGreaterThan": operator.gt, "isAfter": operator.gt, "isLessThan": operator.lt, "isBefore": operator.lt}
#: Operations that hold where another does not.
NEGATIVE = {"isNot": "is", "doesNotContain": "contains"}
OPERATIONS = (*PLAIN, *NEGATIVE, *ORDERED)
ALIASES = {
    "itemtype": "item_type", "dateadded": "date_added", "datemodified": "date_modified", "doi": "doi", "author": "creators", "authors": "creators",
    "creator": "creators", "collection": "collections", "tag": "collections", "tags": "collections", "abstractnote": "abstract", "date": "date_added",
}


@dataclass(frozen=True)
class Condition:
    field: str
    operation: str
    value: str


#: The parts of a condition: what each must be, and how that is said.
PARTS = {
    "field": (lambda v: bool(str(v).strip()), "must not be empty"),
    "operation": (lambda v: v in OPERATIONS, f"must be one of {', '.join(OPERATIONS)}"),
    "value": (lambda v: True, ""),
}


def parse_conditions(conditions, join_mode: str = "all") -> list[Condition]:
    """Validated conditions from a list of dicts or its JSON text. All that is wrong is said at once."""
    given = _from_json(conditions) if isinstance(conditions, str) else conditions
    wrong = [] if join_mode in ("all", "any") else ["join_mode must be all or any"]
    if not (isinstance(given, list) and given):
        raise ValueError("conditions must be a filled list" + "".join(f"; {w}" for w in wrong))
    for n, entry in enumerate(given, 1):
        has = entry if isinstance(entry, dict) else {}
        wrong += [f"condition {n}: {part} is missing" for part in PARTS if part not in has]
        wrong += [f"condition {n}: {part} {rule}" for part, (holds, rule) in PARTS.items() if part in has and not holds(has[part])]
    if wrong:
        raise ValueError("; ".join(wrong))
    return [Condition(str(c["field"]).strip(), c["operation"], str(c["value"])) for c in given]


def _from_json(text: str):
    try:
        return json.loads(text)
    except ValueError as e:
        raise ValueError(f"conditions are no JSON: {e}") from None


def _number(text: str) -> float | None:
    try:
        return float(text)
    except ValueError:
        return None


def _test(value: Column, operation: str, target: str) -> Column:
    left, right = search_key(F.trim(value)), search_key(F.lit(target))
    if operation in NEGATIVE:
        return ~PLAIN[NEGATIVE[operation]](left, right)
    if operation in PLAIN:
        return PLAIN[operation](left, right)
    compare, number, own = ORDERED[operation], _number(target), left.try_cast("double")
    as_text = compare(left, right)
    return as_text if number is None else F.when(own.isNotNull(), compare(own, F.lit(number))).otherwise(as_text)


def condition_column(df: DataFrame, condition: Condition) -> Column:
    """Empty lists match nothing; in a list a positive test holds for some value, a negative one for all. A null scalar is an
    empty text."""
    low = condition.field.lower()
    name = ALIASES.get(low, low)
    if low == "year":
        values = year(F.coalesce("date_added", F.lit("")))
        return F.coalesce(_test(values, condition.operation, condition.value), F.lit(False))
    if name not in df.columns:
        return F.lit(False) if name == "collections" else F.lit(condition.operation in NEGATIVE)
    if name == "creators":
        flipped = lambda x: F.trim(F.concat_ws(" ", F.trim(F.split_part(x, F.lit(","), F.lit(2))), F.trim(F.split_part(x, F.lit(","), F.lit(1)))))
        values = F.transform(creator_names(F.coalesce("creators", F.lit(""))), flipped)
    elif dict(df.dtypes)[name].startswith("array"):
        values = F.coalesce(name, F.array().cast("array<string>"))
    else:
        return _test(F.coalesce(F.col(name).cast("string"), F.lit("")), condition.operation, condition.value)
    check = lambda v: _test(v, condition.operation, condition.value)
    if condition.operation in NEGATIVE:
        return (F.size(values) > 0) & F.forall(values, check)
    return F.exists(values, check)


def advanced_search(df: DataFrame, conditions, join_mode: str = "all") -> DataFrame:
    parsed = parse_conditions(conditions, join_mode)
    whole = condition_column(df, parsed[0])
    for c in parsed[1:]:
        other = condition_column(df, c)
        whole = whole & other if join_mode == "all" else whole | other
    return df.filter(whole)


def set_terms(column: str, terms: list[str]) -> Column:
    """All terms hold; a term is ``a``, ``a || b`` (or ``a OR b``), or ``-a`` for absence."""
    whole = F.lit(True)
    for term in terms:
        if term.startswith("-"):
            own = ~F.coalesce(F.array_contains(column, term[1:].strip()), F.lit(False))
        else:
            names = [x.strip() for part in term.split("||") for x in part.split(" OR ") if x.strip()]
            own = F.coalesce(F.arrays_overlap(column, F.array(*[F.lit(x) for x in names])), F.lit(False))
        whole = whole & own
    return whole


def keyword(columns: list[str], query: str) -> Column:
    """Every word of the query stands somewhere in the columns, marks and case aside."""
    text = search_key(F.concat_ws(" ", *columns))
    whole = F.lit(True)
    for word in query.split():
        whole = whole & text.contains(search_key(F.lit(word)))
    return whole


def with_variants(df: DataFrame, columns: list[str], query: str, key: str) -> DataFrame:
    """Rows matching any spelling of the query, each once, with the number of the first spelling that finds it."""
    text = F.lower(F.concat_ws(" ", *columns))
    first = F.coalesce(*[F.when(text.contains(v.lower()), F.lit(k)) for k, v in enumerate(search_variants(query))])
    return df.withColumn("variant", first).filter("variant is not null")


def cascade(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """The rows of the first step that finds any, marked with its name.

    One pass: each row carries the first step it meets, and the least of these over the data selects.
    """
    order = F.coalesce(*[F.when(c, F.lit(k)) for k, (_, c) in enumerate(steps)])
    names = F.array(*[F.lit(n) for n, _ in steps])
    found = df.withColumn("_step", order).filter("_step is not null")
    least = found.agg(F.min("_step").alias("_least"))
    return found.join(F.broadcast(least), F.col("_step") == F.col("_least")).withColumn("strategy", F.get(names, F.col("_step"))).drop("_step", "_least")
