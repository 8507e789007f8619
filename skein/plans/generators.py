"""Jobs from manifests: named table functions over dimension tables, and the plan of a run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions import text as T
from skein.operators import relations as R

HANDLERS: dict[str, Callable[..., DataFrame]] = {}


def handler(name: str):
    """Registers a table function that makes jobs."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        HANDLERS[name] = f
        return f

    return add


def jobs(name: str, *tables: DataFrame, **how) -> DataFrame:
    if name not in HANDLERS:
        raise ValueError(f"unknown generator {name}; there are {', '.join(sorted(HANDLERS))}")
    return HANDLERS[name](*tables, **how)


def only(rows: DataFrame, folder: str, part: str | None) -> DataFrame:
    """The filter belongs below the numbering: it changes which row gets which attribute."""
    return rows if part is None else rows.where(F.col(folder).contains(part))


@handler("rotation")
def rotation(categories: DataFrame, axes: dict[str, Sequence[str]], part: str | None = None) -> DataFrame:
    """categories(ord, folder, variants): each `variants` times, one category after the other, axes in step."""
    rows = only(categories, "folder", part).select("ord", "folder", F.explode(F.sequence(F.lit(1), F.col("variants"))).alias("variant"))
    return labelled(R.round_robin(rows, ["ord", "variant"], axes))


@handler("interleaved")
def interleaved(categories: DataFrame, axes: dict[str, Sequence[str]], part: str | None = None) -> DataFrame:
    """As rotation, but the first variant of every category, then the second, and so on."""
    rows = only(categories, "folder", part).select("ord", "folder", F.explode(F.sequence(F.lit(1), F.col("variants"))).alias("variant"))
    return labelled(R.round_robin(rows, ["variant", "ord"], axes))


@handler("treatments")
def treatments(symbols: DataFrame, axes: dict[str, Sequence[str]], first: Sequence[str] = ("common", "extra", "extended"), second: Sequence[str] = ("new",), part: str | None = None) -> DataFrame:
    """symbols(ord, folder, lists of treatments): a job for each treatment, numbered within its symbol.

    What the lists of `first` hold is version v1, what those of `second` hold is v2, each symbol's own; a list that symbols
    lack, or that is null, is empty.
    """
    none = F.array().cast("array<string>")
    held = lambda names: F.concat(none, *[F.coalesce(F.col(c), none) for c in names if c in symbols.columns])
    each = symbols.select("ord", "folder", F.size(held(first)).alias("n_first"), F.posexplode(F.concat(held(first), held(second))).alias("variant", "treatment"))
    rows = R.round_robin(only(each, "folder", part), ["variant"], axes, within=["folder"])
    return labelled(rows).withColumn("version", F.when(F.col("variant") < F.col("n_first"), "v1").otherwise("v2")).drop("n_first")


@handler("layouts")
def layouts(archetypes: DataFrame, axes: dict[str, Sequence[str]], sections: Sequence[tuple], part: str | None = None) -> DataFrame:
    """archetypes(ord, folder, zones, and perhaps positions): with the block of zones as text and a summary of it."""
    keys = [k for whole, lanes in sections for k in (whole, *lanes)]
    rows = R.round_robin(only(archetypes, "folder", part), ["ord"], axes)
    return labelled(rows).withColumn("block", T.zone_block(F.col("zones"), sections, F.col("positions") if "positions" in rows.columns else None)).withColumn("summary", T.zone_summary(F.col("zones"), keys))


@handler("assets")
def assets(rows: DataFrame, trigger: str, categories: Sequence[tuple[str, Sequence[str]]], orientations: Sequence[str], part: str | None = None) -> DataFrame:
    """rows(stem, name, orientation, state, tags, description): label, caption, category, path and an empty prompt (nothing is
    generated) of each that has a name; `part`: only those whose file name has it."""
    blank = lambda c: F.nullif(T.trimmed(F.col(c)), F.lit(""))
    rows = only(rows.withColumn("file_", F.concat("stem", F.lit(".png"))), "file_", part).drop("file_")
    rows = rows.withColumns({"name": T.trimmed(F.col("name")), **{c: blank(c) for c in ("orientation", "state", "description")}}).where("name <> ''")
    known = F.array_union(F.transform(F.coalesce("tags", F.array().cast("array<string>")), F.lower), F.split(F.lower("name"), r"\s+"))
    category = F.coalesce(*[F.when(F.arrays_overlap(known, F.array(*[F.lit(w) for w in ws])), F.lit(c)) for c, ws in categories], F.lit("misc"))
    rows = rows.withColumns({"category": category, "state": F.coalesce("state", F.lit("intact")), "orientation": F.coalesce("orientation", F.lit("unknown"))})
    inside = F.col("orientation").isin(*orientations)
    path = F.when(inside, F.concat(F.lit("train/"), F.col("category"))).otherwise(F.concat_ws("/", F.lit("review"), "orientation", "category"))
    caption = T.training_caption(F.lit(trigger), F.col("name"), F.col("orientation"), F.col("state"), F.col("tags"), F.col("description"))
    label = F.concat_ws("/", F.lit("stamp"), "orientation", "category", "stem")
    return rows.withColumns({"path": F.concat(path, F.lit("/"), F.col("stem")), "caption": caption, "label": label, "prompt": F.lit("")})


def labelled(rows: DataFrame) -> DataFrame:
    number = F.lpad((F.col("seq") + 1).cast("string"), 3, "0")
    return rows.withColumn("label", F.concat_ws("_", T.slugify(F.col("folder")), number))


def plan(rows: DataFrame, done: DataFrame, price: float, cap: float, paid: Column) -> DataFrame:
    """The summary of a run and whether its cost is within the cap."""
    return R.cost_plan(rows, done, "label", price, paid).withColumn("admitted", F.col("cost") <= cap)


def sweep(archetypes: DataFrame, seeds: int) -> DataFrame:
    return archetypes.select("*", F.explode(F.sequence(F.lit(1), F.lit(seeds))).alias("seed"))


def stages(names: Sequence[str], only_: Sequence[str] = (), skip: Sequence[str] = ()) -> list[str]:
    """Stages of a run, in order."""
    unknown = {*only_, *skip} - {*names}
    if unknown:
        raise ValueError(f"no such stage: {', '.join(sorted(unknown))}")
    return [n for n in names if (not only_ or n in only_) and n not in skip]


def run_stages(functions: dict[str, Callable[[], object]], only_: Sequence[str] = (), skip: Sequence[str] = (), keep_going: bool = False) -> dict[str, str]:
    """Runs stages in order: ok, or the error, of each; ends at the first error unless told to go on."""
    out = {}
    for name in stages(list(functions), only_, skip):
        try:
            functions[name]()
            out[name] = "ok"
        except Exception as e:
            out[name] = f"{type(e).__name__}: {e}"
            if not keep_going:
                break
    return out
