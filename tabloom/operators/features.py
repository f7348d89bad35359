"""Derived features from a recipe of ratios, products and scaled columns."""

from __future__ import annotations

import ast
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.columns import quoted, safe_divide


@dataclass(frozen=True)
class Feature:
    """One derived column, computed in double.

    ========== ============================= ==========
    kind       value                         inputs
    ========== ============================= ==========
    ratio      a / (b / number), see below   a, b
    product    a * (b / number)              a, b
    scaled     a / number                    a
    power      a ** number                   a
    mean       (a + b) / 2                   a, b
    difference b - a                         a, b
    ========== ============================= ==========

    A ratio is NULL where its denominator is missing, infinite or next to zero.
    """

    name: str
    kind: str
    inputs: tuple[str, ...]
    number: float = 1.0

    def expression(self) -> Column:
        a, b = (quoted(i).cast("double") for i in (self.inputs[0], self.inputs[-1]))
        number = F.lit(float(self.number))
        last = b if self.number == 1 else b / number
        match self.kind:
            case "ratio":
                return safe_divide(a, last)
            case "product":
                return a * last
            case "scaled":
                return last
            case "power":
                return F.pow(a, number)
            case "mean":
                return (a + b) / F.lit(2.0)
            case "difference":
                return b - a
        raise ValueError(f"unknown feature kind {self.kind!r}")


def add_features(df: DataFrame, recipe: Sequence[Feature]) -> DataFrame:
    """Add the recipe's columns whose inputs exist, as float.

    Features that do not build on each other share one projection. A feature built
    on an earlier one sees that column as stored, in single precision.
    """
    have = set(df.columns)
    pending: dict[str, Column] = {}
    for feature in recipe:
        if any(i in pending for i in feature.inputs):
            df, pending = df.withColumns(pending), {}
        if set(feature.inputs) <= have:
            pending[feature.name] = feature.expression().cast("float")
            have.add(feature.name)
    return df.withColumns(pending) if pending else df


_FUNCTIONS = {
    "abs": F.abs,
    "sqrt": F.sqrt,
    "exp": F.exp,
    "log": F.ln,
    "log1p": F.log1p,
    "floor": F.floor,
    "ceil": F.ceil,
    "min": F.least,
    "max": F.greatest,
}


class FormulaError(ValueError):
    """A formula text that cannot be read."""


def formula(text: str, columns: Sequence[str]) -> Column | None:
    """The expression of an arithmetic text, in double; None if it names a column that is absent.

    Names, numbers, ``+ - * / // % **``, signs, brackets and the functions abs, sqrt, exp, log, log1p,
    floor, ceil, min and max. Dividing by anything but a number gives NULL where the divisor is missing,
    infinite or next to zero. Whatever else stands in the text is a FormulaError.
    """
    try:
        tree = ast.parse(text.strip(), mode="eval").body
    except SyntaxError as error:
        raise FormulaError(f"cannot read {text!r}: {error.msg}") from error
    called = {id(n.func) for n in ast.walk(tree) if isinstance(n, ast.Call)}
    names = {n.id for n in ast.walk(tree) if isinstance(n, ast.Name) and id(n) not in called}
    have = set(columns)

    def divide(a: Column, b: Column, divisor: ast.expr) -> Column:
        number = divisor.value if isinstance(divisor, ast.Constant) else None
        return a / b if isinstance(number, (int, float)) and number else safe_divide(a, b)

    def build(node: ast.expr) -> Column:
        match node:
            case ast.Constant(value=int() | float() as number) if not isinstance(number, bool):
                return F.lit(float(number))
            case ast.Name(id=name):
                return quoted(name).cast("double") if name in have else F.lit(None).cast("double")
            case ast.UnaryOp(op=ast.USub(), operand=x):
                return -build(x)
            case ast.UnaryOp(op=ast.UAdd(), operand=x):
                return build(x)
            case ast.BinOp(left=x, op=op, right=y):
                a, b = build(x), build(y)
                match op:
                    case ast.Add():
                        return a + b
                    case ast.Sub():
                        return a - b
                    case ast.Mult():
                        return a * b
                    case ast.Div():
                        return divide(a, b, y)
                    case ast.FloorDiv():
                        return F.floor(divide(a, b, y)).cast("double")
                    case ast.Mod():
                        # As in Python the result has the sign of the divisor.
                        return a - b * F.floor(divide(a, b, y)).cast("double")
                    case ast.Pow():
                        return F.pow(a, b)
            case ast.Call(func=ast.Name(id=name), args=args, keywords=[]) if name in _FUNCTIONS and args:
                return _FUNCTIONS[name](*[build(x) for x in args]).cast("double")
        raise FormulaError(f"cannot read {ast.unparse(node)!r} in {text!r}")

    expression = build(tree)
    return expression if names <= have else None


def add_formulas(df: DataFrame, formulas: Mapping[str, str]) -> DataFrame:
    """Add columns given as arithmetic text (`a / b`, `(a + b) / 2`, `a ** 2`), as float; see formula().

    Formulas that name an absent column are skipped; one that cannot be read raises FormulaError.
    """
    built = {name: formula(text, df.columns) for name, text in formulas.items()}
    added = {name: e.cast("float") for name, e in built.items() if e is not None}
    return df.withColumns(added) if added else df
