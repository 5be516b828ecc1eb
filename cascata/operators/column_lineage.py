"""Where the values of columns come from: attributes followed through analysed plans, and the closure of these steps.

An edge says that a column of a stored table takes part in computing the values of a column of a table made
from it. Conditions of filters and joins decide which rows there are, not their values, and make no
edges. Functions in Python hide what they read, so all columns that go in count.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cascata.session import materialize

EDGE = "origem_tabela string, origem_coluna string, destino_tabela string, destino_coluna string"
Source = tuple[str, str]


def _each(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _plain(folder: str) -> str:
    return re.sub(r"^file:/+", "/", folder).rstrip("/")


def _from_alias(expression, known: dict[int, frozenset[Source]]) -> frozenset[Source]:
    used = _each(expression.references().toSeq())
    return frozenset().union(*(known.get(a.exprId().id(), frozenset()) for a in used))


def _followed(plan, names: dict[str, str]) -> dict[int, frozenset[Source]]:
    """The stored columns behind each output attribute of a plan."""
    children = _each(plan.children())
    below = [_followed(child, names) for child in children]
    known: dict[int, frozenset[Source]] = reduce(lambda a, b: a | b, below, {})
    output, kind = _each(plan.output()), plan.getClass().getSimpleName()
    if not children:
        if kind != "LogicalRelation" or plan.relation().getClass().getSimpleName() != "HadoopFsRelation":
            return {}
        folders = [_plain(p.toString()) for p in _each(plan.relation().location().rootPaths())]
        table = next((name for root, name in names.items() for f in folders if f == root or f.startswith(root + "/")), None)
        return {a.exprId().id(): frozenset({(table, a.name())}) for a in output} if table else {}
    if kind == "Union":
        columns = [_each(child.output()) for child in children]
        return {
            a.exprId().id(): frozenset().union(*(side[c[i].exprId().id()] for side, c in zip(below, columns) if c[i].exprId().id() in side))
            for i, a in enumerate(output)
        }
    made = {}
    if kind == "Expand":
        rows = [_each(p) for p in _each(plan.projections())]
        made = {a.exprId().id(): frozenset().union(*(_from_alias(r[i], known) for r in rows)) for i, a in enumerate(output)}
    elif kind == "Generate":
        read = _from_alias(plan.generator(), known)
        made = {a.exprId().id(): read for a in _each(plan.generatorOutput())}
    else:
        for expression in _each(plan.expressions()):
            if expression.getClass().getSimpleName() == "Alias":
                made[expression.exprId().id()] = _from_alias(expression, known)
    everything = frozenset().union(*known.values()) if known else frozenset()
    return {i: made.get(i, known.get(i, everything)) for i in (a.exprId().id() for a in output)}


def sources(rows: DataFrame, stored: dict[str, str]) -> dict[str, frozenset[Source]]:
    """For each column of a DataFrame, the (table, column) pairs its values are made from; ``stored`` names the folder of each table."""
    plan = rows._jdf.queryExecution().analyzed()
    followed = _followed(plan, {_plain(folder): name for name, folder in stored.items()})
    return {a.name(): followed.get(a.exprId().id(), frozenset()) for a in _each(plan.output())}


def edges(spark: SparkSession, made: dict[str, DataFrame], stored: dict[str, str]) -> DataFrame:
    """One row per edge, from the plans of the tables that are made; nothing is run."""
    found = {(*source, name, column) for name, rows in made.items() for column, reads in sources(rows, stored).items() for source in reads}
    return spark.createDataFrame(sorted(found), EDGE)


def carried(edges_: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Edges with the filled values of their target, counted in the stored tables."""
    counts = []
    for name, rows in tables.items():
        counted = rows.agg(*[F.count(f"`{c}`").alias(c) for c in rows.columns])
        pairs = [F.struct(F.lit(c).alias("destino_coluna"), F.col(f"`{c}`").alias("linhas")) for c in rows.columns]
        counts.append(counted.select(F.lit(name).alias("destino_tabela"), F.inline(F.array(*pairs))))
    return edges_.join(reduce(DataFrame.unionByName, counts), ["destino_tabela", "destino_coluna"])


def closure(edges_: DataFrame) -> DataFrame:
    """Every column that feeds another over any number of steps, with the least number of them.

    Only pairs that were new in a round are carried on in the next, until a round brings none; circles end as well.
    """
    step, target = ["origem_tabela", "origem_coluna"], ["destino_tabela", "destino_coluna"]
    stored = materialize(edges_.select(*step, *target).distinct(), "linhagem")
    back = stored.select(*[F.col(c).alias(f"_{c}") for c in (*step, *target)])
    new = materialize(stored.withColumn("distancia", F.lit(1)), "linhagem")
    reached, distance = new, 1
    while True:
        distance += 1
        meets = [F.col(f"_{t}") == F.col(s) for s, t in zip(step, target)]
        further = new.join(back, meets).select(*[F.col(f"_{c}").alias(c) for c in step], *target).distinct()
        new = materialize(further.join(reached.drop("distancia"), [*step, *target], "left_anti").withColumn("distancia", F.lit(distance)), "linhagem")
        if new.isEmpty():
            return reached
        reached = reached.unionByName(new)
