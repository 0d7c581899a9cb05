"""Table schemas, the cube query object and the binding of dimension names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, types as T

# What names a dataflow in every table: two providers may use the same id.
ENTITY = ("provider", "df_id")
TIME = "TIME_PERIOD"
VALUE = "OBS_VALUE"


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


S, I, L, B, D, TS = (
    T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DateType(), T.TimestampType(),
)

CATALOG = _table(
    ("provider", S), ("df_id", S), ("version", S), ("df_description", S), ("df_structure_id", S),
    ("has_constraint", B), ("df_keywords", S), ("df_last_update", S), ("df_notes", S),
    ("df_bulk_files", S), ("df_geo_dim", S),
)
# Catalog columns a provider may not deliver; conform_schema adds them as null.
OPTIONAL_CATALOG = T.StructType(list(CATALOG.fields)[5:])
DIMENSIONS = _table(("structure_id", S), ("dimension_id", S), ("position", I), ("codelist_id", S))
CODELIST = _table(
    ("codelist_id", S), ("lang", S), ("id", S), ("name", S), ("parent", S), ("order", L),
)
CODELIST_INFO = _table(("codelist_id", S), ("description", S))
CATEGORIES = _table(
    ("scheme_id", S), ("scheme_name", S), ("cat_id", S), ("cat_path", S), ("cat_name", S),
    ("cat_description", S), ("parent_path", S), ("depth", I),
)
CATEGORISATION = _table(("provider", S), ("df_id", S), ("scheme_id", S), ("cat_path", S))
AVAILABLE_CODES = _table(("provider", S), ("df_id", S), ("dimension_id", S), ("code_id", S), ("checked_at", D))
PROBE_STATUS = _table(
    ("provider", S), ("df_id", S), ("df_description", S), ("status", S), ("source", S), ("n_dims", L),
    ("n_codes", L), ("error_count", L), ("last_error", S), ("checked_at", D),
)
TERRITORIAL = _table(
    ("provider", S), ("df_id", S), ("df_description", S), ("dimension_id", S), ("max_level", S), ("levels", S),
    ("n_territories", L), ("checked_at", D),
)
DESCRIPTIONS = _table(
    ("provider", S), ("df_id", S), ("description", S), ("report_id", S), ("metadata_set_id", S), ("siqual_id", S),
    ("harvested_at", D),
)
EMBEDDINGS = _table(("provider", S), ("df_id", S), ("embedding", T.ArrayType(T.FloatType())))
BLACKLIST = _table(("provider", S), ("df_id", S), ("marked_at", TS), ("description", S))

Filters = Mapping[str, object] | Iterable[tuple[str, object]]


@dataclass(frozen=True)
class CubeQuery:
    """What to read from one cube: codes per dimension, a window, a limit per series."""

    dataset: str
    filters: Mapping[str, object] = field(default_factory=dict)
    start: str | None = None
    end: str | None = None
    first_n: int | None = None
    last_n: int | None = None
    labels: bool = False

    @classmethod
    def from_spec(cls, spec: Mapping) -> CubeQuery:
        """Build from a saved query (a plain dict, as a YAML file would hold)."""
        if not spec.get("dataset"):
            raise ValueError("the saved query names no dataset")
        chosen = {dim: entry["value"] for dim, entry in (spec.get("filters") or {}).items()}
        return cls(
            dataset=spec["dataset"], filters=chosen, start=spec.get("start_period"),
            end=spec.get("end_period"), first_n=spec.get("first_n"), last_n=spec.get("last_n"),
            labels=bool(spec.get("labels")),
        )


def fold_name(name: str) -> str:
    """Form under which names are the same: no case, dash as underscore."""
    return name.upper().replace("-", "_")


def codes_of(value: object) -> list[str]:
    """Codes of one filter value; an empty list stands for "all codes"."""
    parts = value.split("+") if isinstance(value, str) else [str(v) for v in value or []]
    return list(dict.fromkeys(p for p in parts if p not in ("", ".")))


def bind_dims(columns: Sequence[str], filters: Filters) -> dict[str, list[str]]:
    """Resolve filter names to columns and merge repeated names.

    The column of that very id (up to case) wins; otherwise the only column with
    the same folded name.  Anything else is an error, never a dropped filter.
    """
    pairs = filters.items() if isinstance(filters, Mapping) else filters
    bound: dict[str, list[str]] = {}
    unknown: list[str] = []
    for name, value in pairs:
        hits = [c for c in columns if c.upper() == name.upper()]
        hits = hits or [c for c in columns if fold_name(c) == fold_name(name)]
        if len(hits) != 1:
            unknown.append(name)
            continue
        codes = bound.setdefault(hits[0], [])
        codes.extend(code for code in codes_of(value) if code not in codes)
    if unknown:
        raise ValueError(
            f"no single dimension for: {', '.join(unknown)}; dimensions are {', '.join(columns)}"
        )
    return bound


def key_of(filters: Mapping[str, object]) -> str:
    """Positional key text of filters given in dimension order."""
    return ".".join("+".join(codes_of(value)) for value in filters.values())


def filters_of_key(key: str, dims: Sequence[str]) -> dict[str, str]:
    """Filters of a positional key: ``.`` parts dimensions, an empty part is "all"."""
    parts = key.split(".") if key else []
    if len(parts) > len(dims):
        raise ValueError(f"key {key!r} has {len(parts)} parts for {len(dims)} dimensions")
    return {dim: part for dim, part in zip(dims, parts) if part}


def check_entity(*frames: DataFrame) -> None:
    """Every table that names dataflows names them by provider and id; a table without a provider is an error."""
    for frame in frames:
        missing = [c for c in ENTITY if c not in frame.columns]
        if missing:
            raise ValueError(f"a table of dataflows needs {', '.join(ENTITY)}; this one has no {', '.join(missing)}: {', '.join(frame.columns)}")
