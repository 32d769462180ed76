"""Declarative dataset description: which columns a table has and what role each one plays."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession, types as T

_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


def names(value) -> tuple[str, ...]:
    """Split a comma list (or take a sequence) into trimmed lower-case names without repeats."""
    if value is None:
        return ()
    parts = value.split(",") if isinstance(value, str) else [str(v) for v in value]
    return tuple(dict.fromkeys(p.strip().lower() for p in parts if p.strip()))


def codes(value) -> tuple[str, ...]:
    """Response codes: ``1``, ``"1,2,3"`` or a list, always as text."""
    if value is None:
        return ()
    if isinstance(value, (list, tuple, set)):
        return tuple(str(v).strip() for v in value)
    return tuple(p.strip() for p in str(value).split(",") if p.strip())


@dataclass(frozen=True)
class Range:
    """Inclusive bounds of one column; ``None`` is an open end."""

    column: str
    low: float | None = None
    high: float | None = None

    @classmethod
    def parse(cls, text: str) -> Range:
        column, low, high = (p.strip() for p in text.split(","))
        return cls(column.lower(), *(None if p == "*" else int(p) for p in (low, high)))


@dataclass(frozen=True)
class ResponseCodes:
    """How the response codes of one action map to labels."""

    positives: tuple[str, ...] = ()
    negatives: tuple[str, ...] = ()
    pending: tuple[str, ...] = ()


@dataclass(frozen=True)
class DatasetSpec:
    """Columns and roles of one table. Columns that are not categorical are numeric."""

    fields: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    ignored: tuple[str, ...] = ()
    predictors: tuple[str, ...] = ()
    target: str | None = None
    ranges: tuple[Range, ...] = ()
    groups: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    responses: Mapping[str, ResponseCodes] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)
    options: Mapping[str, object] = field(default_factory=dict)

    def __post_init__(self):
        known = set(self.fields)
        used = [*self.predictors, *(r.column for r in self.ranges)]
        used += [c for group in self.groups.values() for c in group]
        used += [self.target] if self.target else []
        missing = sorted({c for c in used if c not in known})
        if missing:
            raise ValueError(f"columns used by the spec but not declared: {missing}")

    def schema(self) -> T.StructType:
        """Positional schema for headerless text; integers unless ``types`` says otherwise."""
        return T.StructType(
            [
                T.StructField(f, _TYPES[self.types.get(f, "int")], True, {"role": self.role(f)})
                for f in self.fields
            ]
        )

    def role(self, column: str) -> str:
        if column in self.ignored:
            return "ignored"
        return "categorical" if column in self.categorical else "numeric"

    def split_roles(self, columns: Iterable[str]) -> tuple[list[str], list[str]]:
        """(categorical, numeric) columns in the given order, ignored ones left out."""
        kept = [c for c in columns if c not in self.ignored]
        return (
            [c for c in kept if c in self.categorical],
            [c for c in kept if c not in self.categorical],
        )

    def model_columns(self) -> list[str]:
        """Predictors that are not ignored, in configured order."""
        return [c for c in self.predictors if c not in self.ignored]

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> DatasetSpec:
        raw = json.loads(text)
        raw["ranges"] = tuple(Range(**r) for r in raw["ranges"])
        raw["responses"] = {
            k: ResponseCodes(**{n: tuple(v) for n, v in r.items()})
            for k, r in raw["responses"].items()
        }
        raw["groups"] = {k: tuple(v) for k, v in raw["groups"].items()}
        for key in ("fields", "categorical", "ignored", "predictors"):
            raw[key] = tuple(raw[key])
        return cls(**raw)

    @classmethod
    def from_mapping(cls, cfg: Mapping, types: Mapping[str, str] | None = None) -> DatasetSpec:
        """Build a spec from the application config keys (``fields``, ``f_categories``, ...)."""
        target = cfg.get("f_target") or (cfg.get("target") or {}).get("name")
        groups = {g: names(cfg[g]) for g in names(cfg.get("clusters"))}
        groups |= {g: names(cfg[g]) for g in ("female_fields", "male_fields") if g in cfg}
        # fixed values: the config files spell the negative list this way
        positives, negatives = cfg.get("positives") or {}, cfg.get("negetives") or {}
        pending = cfg.get("pending") or {}
        responses = {
            action: ResponseCodes(
                codes(positives.get(action)), codes(negatives.get(action)), codes(pending.get(action))
            )
            for action in dict.fromkeys([*positives, *negatives, *pending])
        }
        fields = names(cfg["fields"])
        return cls(
            fields=fields,
            categorical=names(cfg.get("f_categories")),
            ignored=tuple(c for c in names(cfg.get("f_ignore")) if c in fields),
            predictors=names(cfg.get("f_predictors")),
            target=target.strip().lower() if target else None,
            ranges=tuple(Range.parse(r) for r in cfg.get("ranges") or ()),
            groups=groups,
            responses=responses,
            types=dict(types or {}),
            options={k: cfg[k] for k in ("topn", "forest", "logistic", "datafiles") if k in cfg},
        )


def load_spec(spark: SparkSession, path: str, types: Mapping[str, str] | None = None) -> DatasetSpec:
    """Read a YAML application config from any Spark-readable path."""
    import yaml

    text = spark.read.text(path, wholetext=True).first()[0]
    return DatasetSpec.from_mapping(yaml.safe_load(text), types)
