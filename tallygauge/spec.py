"""What to measure: metric specifications and the parameters they come from."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

# The parameter names existing jobs pass, the names metrics carry in
# the output, and the value an unset parameter holds.
COLUMN_PARAMETERS = {
    "ApproxCountDistinctCol": "ApproxCountDistinct",
    "CompletenessCol": "Completeness",
    "CountDistinctCol": "CountDistinct",
    "DataTypeCol": "DataType",
    "DistinctnessCol": "Distinctness",
    "EntropyCol": "Entropy",
    "MaximumCol": "Maximum",
    "MeanCol": "Mean",
    "MinimumCol": "Minimum",
    "SumCol": "Sum",
    "UniqueValueRatioCol": "UniqueValueRatio",
    "UniquenessCol": "Uniqueness",
}
PAIRED_PARAMETERS = {
    "ComplianceCol": ("Compliance", ("ComplianceLogic",)),
    "CorrelationCol": ("Correlation", ("CorrelationCol2", "CorrelationLogic")),
    "MutualInformationCol": ("MutualInformation", ("MutualInformationOtheCol",)),
    "PatternMatchCol": ("PatternMatch", ("PatternMatchPattern",)),
    "ApproxQuantileCol": ("ApproxQuantile", ("quantile",)),
}
UNSET = ("", "false")

NUMERIC = ("Mean", "Minimum", "Maximum", "Sum", "Correlation", "ApproxQuantile")
FREQUENCY = ("CountDistinct", "Distinctness", "Entropy", "UniqueValueRatio", "Uniqueness")
SCAN = (
    "Size",
    "Completeness",
    "ApproxCountDistinct",
    "Mean",
    "Compliance",
    "Correlation",
    "DataType",
    "Maximum",
    "Minimum",
    "Sum",
    "PatternMatch",
    "ApproxQuantile",
)
JOINT = ("MutualInformation",)
PAIRS = ("Correlation", "MutualInformation")


@dataclass(frozen=True)
class Metric:
    """One metric on zero, one or two columns.

    ``label`` names a Compliance rule, ``expression`` holds its predicate (or the
    regular expression of a PatternMatch) and ``quantile`` belongs to ApproxQuantile.
    """

    kind: str
    columns: tuple[str, ...] = ()
    label: str | None = None
    expression: str | None = None
    quantile: float | None = None

    def __post_init__(self) -> None:
        if self.kind not in SCAN + FREQUENCY + JOINT:
            raise ValueError(f"unknown metric {self.kind!r}")
        arity = 2 if self.kind in PAIRS else 0 if self.kind in ("Size", "Compliance") else 1
        if len(self.columns) != arity:
            raise ValueError(f"{self.kind} takes {arity} column(s), got {list(self.columns)}")
        if self.kind == "Compliance" and not (self.label and self.expression):
            raise ValueError("Compliance needs a label and a predicate")
        if self.kind == "PatternMatch" and not self.expression:
            raise ValueError("PatternMatch needs a pattern")
        if self.kind == "ApproxQuantile" and (self.quantile is None or not 0.0 <= self.quantile <= 1.0):
            raise ValueError("ApproxQuantile needs a quantile between 0 and 1")

    @property
    def entity(self) -> str:
        if self.kind == "Size":
            return "Dataset"
        return "Multicolumn" if self.kind in PAIRS else "Column"

    @property
    def instance(self) -> str:
        if self.kind == "Size":
            return "*"
        return self.label if self.kind == "Compliance" else ",".join(self.columns)

    @property
    def name(self) -> str:
        return f"ApproxQuantile-{self.quantile}" if self.kind == "ApproxQuantile" else self.kind


def size() -> list[Metric]:
    return [Metric("Size")]


def on(kind: str, columns: str | Iterable[str]) -> list[Metric]:
    """One metric of ``kind`` for each column of a comma list or sequence."""
    return [Metric(kind, (c,)) for c in split_list(columns)]


def pairs(kind: str, first: str | Iterable[str], second: str | Iterable[str]) -> list[Metric]:
    """One two-column metric for each position of two equally long lists."""
    return [Metric(kind, (a, b)) for a, b in zip_lists(kind, first, second)]


def compliance(labels: str | Iterable[str], predicates: str | Iterable[str]) -> list[Metric]:
    """The share of rows for which each predicate is true."""
    return [
        Metric("Compliance", label=label, expression=predicate)
        for label, predicate in zip_lists("Compliance", labels, predicates)
    ]


def pattern_match(column: str, pattern: str) -> list[Metric]:
    return [Metric("PatternMatch", (column,), expression=pattern)]


def approx_quantile(columns: str | Iterable[str], quantile: float) -> list[Metric]:
    return [Metric("ApproxQuantile", (c,), quantile=float(quantile)) for c in split_list(columns)]


def split_list(value: str | Iterable[str]) -> list[str]:
    """A comma list or a sequence as trimmed, non-empty items.

    Commas inside parentheses, brackets or quotes do not split, so predicates such as
    ``kind IN ('a', 'b')`` and ``coalesce(a, abs(b)) > 1`` stay whole.
    """
    if isinstance(value, str):
        value = cut_at_commas(value)
    return [item.strip() for item in value if item and item.strip()]


def cut_at_commas(text: str) -> list[str]:
    """The parts of a text between the commas that stand outside of every bracket and quote."""
    parts, depth, quote, start, i = [], 0, "", 0, 0
    while i < len(text):
        c = text[i]
        if quote:
            if c == "\\" and quote != "`":
                i += 1
            elif c == quote:
                quote = ""
        elif c in "'\"`":
            quote = c
        elif c in "([{":
            depth += 1
        elif c in ")]}":
            depth = max(0, depth - 1)
        elif c == "," and not depth:
            parts.append(text[start:i])
            start = i + 1
        i += 1
    return [*parts, text[start:]]


def zip_lists(kind: str, first, second) -> list[tuple[str, str]]:
    left, right = split_list(first), split_list(second)
    if len(left) != len(right):
        raise ValueError(
            f"{kind}: {len(left)} entries in the first list but {len(right)} in the second"
        )
    return list(zip(left, right))


def from_parameters(parameters: Mapping[str, object]) -> list[Metric]:
    """Expand job parameters into metrics; Size is always measured.

    A parameter that is missing, empty or left at its default is unset and yields nothing.
    """

    def given(key: str):
        value = parameters.get(key)
        if value is None or (isinstance(value, str) and value.strip().lower() in UNSET):
            return None
        return value

    metrics = size()
    for parameter, kind in COLUMN_PARAMETERS.items():
        if given(parameter) is not None:
            metrics += on(kind, given(parameter))
    for parameter, (kind, others) in PAIRED_PARAMETERS.items():
        other = next((given(o) for o in others if given(o) is not None), None)
        if given(parameter) is None and other is None:
            continue
        if given(parameter) is None or other is None:
            raise ValueError(f"{parameter} and {others[0]} must be given together")
        if kind == "PatternMatch":
            # A pattern is one regular expression, commas and all; several come as a list.
            patterns = [other] if isinstance(other, str) else list(other)
            for column, pattern in zip_lists(kind, given(parameter), patterns):
                metrics += pattern_match(column, pattern)
        elif kind == "ApproxQuantile":
            for column, quantile in zip_lists(kind, given(parameter), map(str, split_numbers(other))):
                metrics += approx_quantile([column], float(quantile))
        elif kind == "Compliance":
            metrics += compliance(given(parameter), other)
        else:
            metrics += pairs(kind, given(parameter), other)
    return metrics


def split_numbers(value) -> list:
    if isinstance(value, str):
        return split_list(value)
    return list(value) if isinstance(value, Iterable) else [value]


def distinct_metrics(metrics: Iterable[Metric]) -> list[Metric]:
    """Drop repeated metrics; two different metrics may not share an output key."""
    kept: dict[tuple[str, str], Metric] = {}
    for metric in metrics:
        known = kept.setdefault((metric.instance, metric.name), metric)
        if known != metric:
            raise ValueError(f"two metrics share the key {metric.instance}-{metric.name}")
    return list(kept.values())
