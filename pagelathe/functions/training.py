"""Columns for training rows: label masks, limits and durations."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

IGNORED = -100

# What a run's settings may be, memory in GB of models (base, per 1024 tokens) and of devices.
MODELS = {"0.5B": (4, 0.5), "1.5B": (8, 1.0), "3B": (14, 2.0)}
DEVICES = {
    "NVIDIA GeForce RTX 4090": 24,
    "NVIDIA RTX A6000": 48,
    "NVIDIA A100-SXM4-80GB": 80,
    "NVIDIA A100 80GB PCIe": 80,
    "NVIDIA H100 80GB HBM3": 80,
    "NVIDIA L40S": 48,
}
PHASES, RANKS = ("sft", "grpo"), (8, 16, 32, 64)
SETTINGS = (
    "run_name model phases max_seq_len sft_max_steps gpu_type max_runtime hf_dataset_revision sft_epochs sft_lr sft_batch"
    " sft_grad_accum grpo_epochs grpo_lr grpo_num_generations grpo_max_completion grpo_beta grpo_temperature reward_beta lora_r"
).split()
LENGTHS, RATES, FULL = (1024, 16384), (1e-6, 1e-2), 0.8


def masked_labels(ids: Column, template: list[int], end: int) -> Column:
    """Token ids as labels, with IGNORED up to the last occurrence of the answer's template and behind the first end after it.

    A row without the template has no labels at all.
    """
    n = len(template)
    wanted = F.array(*map(F.lit, template))
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.size(ids) - n + 1, F.lit(1))), lambda i: F.slice(ids, i, n) == wanted)
    begin = F.coalesce(F.try_element_at(places, F.lit(-1)) + n, F.size(ids) + 1)  # first label, from 1
    stops = F.filter(F.sequence(F.lit(1), F.greatest(F.size(ids), F.lit(1))), lambda i: (i >= begin) & (F.try_element_at(ids, i.cast("int")) == end))
    stop = F.coalesce(F.try_element_at(stops, F.lit(1)), F.size(ids))
    return F.transform(ids, lambda x, i: F.when((i + 1 >= begin) & (i + 1 <= stop), x).otherwise(IGNORED))


def has_labels(labels: Column) -> Column:
    return F.exists(labels, lambda x: x != IGNORED)


def seconds(duration: Column) -> Column:
    """Seconds of a duration like 6h, 30m or 3600s; null for anything else."""
    n = F.regexp_extract(duration, r"^(\d+)[hms]$", 1).try_cast("bigint")
    unit = F.right(duration, F.lit(1))
    return n * F.when(unit == "h", 3600).when(unit == "m", 60).otherwise(1)


def memory_gb(model: Column, length: Column, batch: Column) -> Column:
    """Estimated device memory of a run; null for an unknown model."""
    part = lambda i: F.element_at(F.create_map(*[F.lit(x) for k, v in MODELS.items() for x in (k, float(v[i]))]), model)
    known = model.isin(*MODELS)
    return F.when(known, (F.when(known, part(0)) + F.when(known, part(1)) * length / 1024) * batch)


def setting_problems(settings: dict) -> tuple[list[str], list[str]]:
    """(errors, warnings): names of settings that are wrong or doubtful, each with its reason."""
    value = lambda name, other="": settings.get(name, other)
    phases = {p.strip() for p in value("phases").split(",")} if value("phases") else set()
    within = lambda x, limits: limits[0] <= x <= limits[1]
    checks = [
        ("run_name", re.match(r"^[a-z0-9._-]+$", value("run_name")), "lower-case letters, digits, dots, lines"),
        ("model", value("model") in MODELS, "one of " + ", ".join(MODELS)),
        ("phases", phases <= set(PHASES), "of " + ", ".join(PHASES)),
        ("max_seq_len", within(value("max_seq_len", 0), LENGTHS), "between %d and %d" % LENGTHS),
        ("hf_dataset_revision", value("hf_dataset_revision"), "needed"),
        ("max_runtime", re.match(r"^\d+[hms]$", str(value("max_runtime")).strip()), "like 6h, 30m or 3600s"),
        ("lora_r", value("lora_r", RANKS[0]) in RANKS, "one of " + ", ".join(map(str, RANKS))),
        ("sft_max_steps", not (value("sft_max_steps", 0) > 0 and "grpo" in phases), "a run with a step limit has no second phase"),
        *[(name, within(value(name, RATES[0]), RATES), "between %g and %g" % RATES) for name in ("sft_lr", "grpo_lr")],
    ]
    errors = [f"{name}: unknown" for name in sorted(set(settings) - set(SETTINGS))] + [f"{name}: {why}" for name, good, why in checks if not good]
    warnings, revision = [], value("hf_dataset_revision")
    if revision == "main":
        warnings.append("hf_dataset_revision: not pinned")
    elif revision and not re.match(r"^[0-9a-f]{7,40}$", revision):
        warnings.append("hf_dataset_revision: no hash of a revision")
    base, each = MODELS.get(value("model"), (0, 0))
    device = DEVICES.get(value("gpu_type"))
    if base and device and isinstance(value("max_seq_len", 0), int):
        need = (base + each * value("max_seq_len", 0) / 1024) * value("sft_batch", 1)
        if need > FULL * device:
            warnings.append(f"gpu_type: about {need:.0f} of {device} GB")
    return errors, warnings
