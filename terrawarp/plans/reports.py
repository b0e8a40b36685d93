"""What drivers report and keep: summaries, run parameters, results of an evaluation, checkpoints, and configurations."""

from __future__ import annotations

import importlib.util
import json
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrawarp.plans.jobs import merge_options


def source_counts(pairs: DataFrame) -> DataFrame:
    """One row: pairs by split, and those without one."""
    of = lambda s: F.count_if(F.col("split") == s)
    return pairs.agg(F.count("*").alias("n_pairs"), of("train").alias("n_train"), of("val").alias("n_val"), F.count_if(F.col("split").isNull()).alias("n_unassigned"))


def shares(counts: DataFrame) -> DataFrame:
    """Tile counts (kind, split, n) with the share of their kind, and the line that a summary shows for each."""
    total = counts.groupBy("kind").agg(F.sum("n").alias("total"))
    rows = counts.join(total, "kind").withColumn("percent", F.round(F.col("n") * 100.0 / F.col("total"), 1))
    split = F.coalesce("split", F.lit("unassigned"))
    return rows.select("kind", "split", "n", "percent", F.concat(F.col("kind"), F.lit("/"), split, F.lit(": "), F.col("n").cast("string"), F.lit(" tiles ("), F.format_number("percent", 1), F.lit("%)")).alias("line"))


def summary_text(counts: list, sources: dict, parameters: dict) -> str:
    """The text that ends a tiling run, from rows (kind, split, n, percent, line), source counts and parameters."""
    lines = ["parameters:", *(f"  {k}: {v}" for k, v in parameters.items()), "sources:", *(f"  {k}: {v}" for k, v in sources.items()), "tiles:"]
    lines += [f"  {r['line']}" for r in sorted(counts, key=lambda r: (r["kind"], r["split"] or "~"))]
    return "\n".join([*lines, f"  total: {sum(r['n'] for r in counts)}"])


def run_row(spark: SparkSession, job: str, parameters: dict) -> DataFrame:
    """One row (job, parameters as JSON) for a log of runs."""
    return spark.createDataFrame([(job, json.dumps(parameters, sort_keys=True, default=str))], "job string, parameters string")


def write_evaluation(per_class: DataFrame, mean: DataFrame, config: str, path: str) -> None:
    """One JSON line: the configuration's name and the metrics, IoU by class and their mean."""
    by = per_class.agg(F.sort_array(F.collect_list(F.struct("class", "iou"))).alias("iou"))
    row = by.crossJoin(mean).select(F.lit(config).alias("config"), F.struct("iou", "miou").alias("metric"))  # one row each
    row.coalesce(1).write.mode("overwrite").json(path)


def write_results(rows: DataFrame, path: str) -> None:
    """Results of a run as Parquet; names that ask for pickled objects are refused."""
    if path.endswith((".pkl", ".pickle")):
        raise ValueError("results are written as Parquet, not pickled")
    rows.write.mode("overwrite").parquet(path)


def load_checkpoint(path: str, prefixes: tuple[str, ...] = ("module.", "backbone.")) -> dict[str, np.ndarray]:
    """The arrays of an .npz file by name, each without the first of these prefixes that it has. Driver-side; broadcast
    what scorers need."""
    with np.load(path, allow_pickle=False) as data:
        out = {}
        for name in data.files:
            short = next((name[len(p) :] for p in prefixes if name.startswith(p)), name)
            if short in out:
                raise ValueError(f"two arrays of a checkpoint are named {short}")
            out[short] = data[name]
        return out


def load_config(path: str, seen: tuple[str, ...] = ()) -> dict:
    """A configuration (a Python file's public names, or JSON) over those that its `_base_` names, in order."""
    file = Path(path).resolve()
    if str(file) in seen:
        raise ValueError(f"a configuration is its own base: {file}")
    if file.suffix == ".json":
        own = json.loads(file.read_text())
    else:
        spec = importlib.util.spec_from_file_location(f"_config_{abs(hash(str(file)))}", file)
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        own = {k: v for k, v in vars(module).items() if k == "_base_" or not k.startswith("_") and isinstance(v, (str, int, float, bool, list, tuple, dict, type(None)))}
    bases = own.pop("_base_", [])
    out: dict = {}
    for base in [bases] if isinstance(bases, str) else bases:
        out = merge_options(out, load_config(str(file.parent / base), (*seen, str(file))))
    for key, value in own.items():
        out = merge_options(out, {key: value}) if "." not in key else {**out, key: value}
    return out
