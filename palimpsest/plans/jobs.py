"""Declarative jobs: prompts, limits, arms, and their validation with named errors."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from palimpsest.functions.trim import RULES

#: Where a grounded prompt takes the document.
PLACEHOLDER = "[TEXT]"
# The order of the styles is part of the seeded draw.
STYLES = ["easy", "hard", "wiki", "qa"]
MODES = ["grounded", "wrap_multi"]
# The output columns in order, how a styled prompt ends, and the chat template below.
OUTPUT_KEYS = ["doc_id", "record_id", "arm", "prompt_id", "source_text_sha1", "rewritten_text", "finish_reason", "n_prompt_tokens", "n_output_tokens", "status", "n_output_tokens_llama2", "wrap_style"]
STYLE_END = "\n\nPassage:\n"


# What may be said to the model's engine and sampler.
ENGINE_KEYS = {"tensor_parallel_size", "dtype", "gpu_memory_utilization", "max_model_len"}
SAMPLING_KEYS = {"temperature", "top_p", "max_tokens"}


class ConfigError(ValueError):
    """A job table that can't be run; the message says what to change."""


@dataclass(frozen=True)
class Limits:
    max_model_len: int = 32768
    max_tokens: int = 4096


@dataclass(frozen=True)
class ChatTemplate:
    prefix: str = "<|im_start|>user\n"
    suffix: str = "<|im_end|>\n<|im_start|>assistant\n"


@dataclass(frozen=True)
class PromptSpec:
    name: str
    mode: str
    trim: str
    text: str = ""
    styles: dict[str, str] = field(default_factory=dict)
    input_drop: int | None = None
    overheads: dict[str, int] = field(default_factory=dict)
    ratio: float = 0.0

    def check(self) -> None:
        if self.mode not in MODES:
            raise ConfigError(f"prompt {self.name}: mode {self.mode!r} is none of {MODES}")
        if self.trim not in RULES:
            raise ConfigError(f"prompt {self.name}: trim {self.trim!r} is none of {sorted(RULES)}")
        if (self.mode == "wrap_multi") != (self.trim == "wrap"):
            raise ConfigError(f"prompt {self.name}: trim 'wrap' goes with mode 'wrap_multi' and no other")
        if self.mode == "grounded":
            if self.text.count(PLACEHOLDER) != 1:
                raise ConfigError(f"prompt {self.name}: its text must hold {PLACEHOLDER} once")
            if self.styles:
                raise ConfigError(f"prompt {self.name}: a grounded prompt has no styles")
        else:
            if self.text:
                raise ConfigError(f"prompt {self.name}: a styled prompt has no text beside its styles")
            if list(self.styles) != STYLES:
                raise ConfigError(f"prompt {self.name}: styles must be {STYLES} in this order")
            if len(set(self.styles.values())) != len(self.styles):
                raise ConfigError(f"prompt {self.name}: two styles have the same text")
            for style, text in self.styles.items():
                if not text.endswith(STYLE_END) or PLACEHOLDER in text:
                    raise ConfigError(f"prompt {self.name}: style {style} must end with {STYLE_END!r} and hold no {PLACEHOLDER}")
        if self.input_drop is not None and self.input_drop <= 0:
            raise ConfigError(f"prompt {self.name}: input_drop must be positive")


@dataclass(frozen=True)
class Arm:
    name: str
    subdir: str
    prompts: tuple[str, ...]
    docs: int | None = None
    source_tokens: int | None = None
    ratios: tuple[float, ...] = ()


@dataclass(frozen=True)
class JobTable:
    arms: list[Arm]
    prompts: dict[str, PromptSpec]
    limits: Limits = Limits()
    keys: list[str] = field(default_factory=lambda: list(OUTPUT_KEYS))
    target_rows: int = 5000
    target_bytes: int = 64 << 20
    expected_jobs: int | None = None

    def check(self) -> JobTable:
        """Raise ConfigError at the first fault; returns itself."""
        if self.limits.max_tokens >= self.limits.max_model_len:
            raise ConfigError("limits: max_tokens must be below max_model_len")
        if self.target_rows < 1 or self.target_bytes < 1:
            raise ConfigError("sharding: targets must be positive")
        for what in ("name", "subdir"):
            seen = [getattr(a, what) for a in self.arms]
            if len(set(seen)) != len(seen):
                raise ConfigError(f"arms: {what} occurs twice")
        for key in ("doc_id", "arm", "prompt_id", "rewritten_text", "status"):
            if key not in self.keys:
                raise ConfigError(f"output: {key} is missing")
        if len(set(self.keys)) != len(self.keys):
            raise ConfigError("output: a key occurs twice")
        for p in self.prompts.values():
            p.check()
        for a in self.arms:
            if not a.prompts:
                raise ConfigError(f"arm {a.name}: no prompts")
            if a.ratios and len(a.ratios) != len(a.prompts):
                raise ConfigError(f"arm {a.name}: {len(a.ratios)} ratios for {len(a.prompts)} prompts")
            for what in ("docs", "source_tokens"):
                if (getattr(a, what) or 0) < 0:
                    raise ConfigError(f"arm {a.name}: {what} must not be negative")
            for name in a.prompts:
                if name not in self.prompts:
                    raise ConfigError(f"arm {a.name}: no prompt {name!r}")
            if len(set(a.prompts)) != len(a.prompts):
                raise ConfigError(f"arm {a.name}: a prompt occurs twice")
        if self.expected_jobs is not None and len(self.jobs()) != self.expected_jobs:
            raise ConfigError(f"{len(self.jobs())} jobs where {self.expected_jobs} are expected")
        return self

    def jobs(self) -> list[tuple[Arm, PromptSpec]]:
        return [(a, self.prompts[p]) for a in self.arms for p in a.prompts]

    def job(self, job_id: str) -> tuple[Arm, PromptSpec]:
        for a, p in self.jobs():
            if f"{a.name}__{p.name}" == job_id:
                return a, p
        raise ConfigError(f"no job {job_id!r}")


def check_settings(settings: dict) -> dict:
    """The sections engine, sampling, compute, output and upload of a run; ConfigError at the first fault.

    Sections that are missing take defaults. Returns all of them.
    """
    known = {"engine", "sampling", "compute", "output", "upload"}
    if set(settings) - known:
        raise ConfigError(f"unknown sections {sorted(set(settings) - known)}")
    engine = settings.get("engine", {"tensor_parallel_size": 1, "dtype": "bfloat16", "gpu_memory_utilization": 0.9, "max_model_len": Limits().max_model_len})
    extra, missing = sorted(set(engine) - ENGINE_KEYS), sorted(ENGINE_KEYS - set(engine))
    if extra or missing:
        raise ConfigError(f"engine: unexpected {extra}, missing {missing}")
    if engine["tensor_parallel_size"] != 1:
        raise ConfigError("engine: tensor_parallel_size must be 1; workers are independent")
    sampling = settings.get("sampling", {})
    if set(sampling) - SAMPLING_KEYS:
        raise ConfigError(f"sampling: unexpected {sorted(set(sampling) - SAMPLING_KEYS)}")

    compute = {"num_gpus": 1, "gpu_ids": None, "fleet_gpus": None, "shard_assignment": "dynamic", "scheduler": "bash", "allowed_gpu_arch": ["sm_100"]} | settings.get("compute", {})
    for what in ("num_gpus", "fleet_gpus"):
        n = compute[what]
        if n is None and what == "fleet_gpus":
            continue
        if isinstance(n, bool) or not isinstance(n, int):
            raise ConfigError(f"compute: {what} must be an integer, not {n!r}")
        if n < 1:
            raise ConfigError(f"compute: {what} must be at least 1")
    if compute["gpu_ids"] is not None and len(compute["gpu_ids"]) != compute["num_gpus"]:
        raise ConfigError(f"compute: {len(compute['gpu_ids'])} gpu_ids for {compute['num_gpus']} GPUs")
    if compute["fleet_gpus"] is not None and compute["fleet_gpus"] < compute["num_gpus"]:
        raise ConfigError("compute: fleet_gpus counts all nodes and can't be below num_gpus")
    for what, allowed in (("shard_assignment", ("dynamic", "static")), ("scheduler", ("bash", "slurm"))):
        if compute[what] not in allowed:
            raise ConfigError(f"compute: {what} {compute[what]!r} is none of {allowed}")
    if not compute["allowed_gpu_arch"]:
        raise ConfigError("compute: allowed_gpu_arch must name at least one")
    for arch in compute["allowed_gpu_arch"]:
        if not re.fullmatch(r"sm_[0-9]+[a-z]?", str(arch)):
            raise ConfigError(f"compute: allowed_gpu_arch {arch!r} doesn't look like sm_100")

    output = {"compression": "zstd"} | settings.get("output", {})
    if output["compression"] not in ("zstd", "none"):
        raise ConfigError(f"output: compression {output['compression']!r} is neither zstd nor none")
    upload = {"enabled": False, "repo_template": "", "stage": "shuffled"} | settings.get("upload", {})
    if not isinstance(upload["enabled"], bool):
        raise ConfigError(f"upload: enabled must be true or false, not {upload['enabled']!r}")
    if upload["enabled"] and not upload["repo_template"]:
        raise ConfigError("upload: enabled without a repo_template")
    if upload["repo_template"] and not {"{arm}", "{prompt_id}"} <= set(re.findall(r"\{\w+\}", upload["repo_template"])):
        raise ConfigError("upload: repo_template needs {arm} and {prompt_id}, else jobs overwrite each other")
    if upload["stage"] not in ("raw", "trimmed", "shuffled"):
        raise ConfigError(f"upload: stage {upload['stage']!r} is none of raw, trimmed, shuffled")
    return {"engine": engine, "sampling": sampling, "compute": compute, "output": output, "upload": upload}


def load_jobs(config: dict, read_text=None) -> JobTable:
    """A checked job table from plain values, as a JSON or YAML file gives them.

    A prompt's `text` or `styles` may be replaced by `file` and `style_files`, which
    `read_text` turns into texts, read as they are.
    """
    known = {"arms", "prompts", "limits", "keys", "sharding", "expected_jobs"}
    if set(config) - known:
        raise ConfigError(f"unknown sections {sorted(set(config) - known)}")
    prompts = {}
    for name, p in config.get("prompts", {}).items():
        fields = dict(p)
        if "file" in fields:
            fields["text"] = read_text(fields.pop("file"))
        if "style_files" in fields:
            fields["styles"] = {s: read_text(f) for s, f in fields.pop("style_files").items()}
        try:
            prompts[name] = PromptSpec(name, **fields)
        except TypeError as e:
            raise ConfigError(f"prompt {name}: {e}") from None
    try:
        arms = [Arm(**{**a, "prompts": tuple(a["prompts"]), "ratios": tuple(a.get("ratios", ()))}) for a in config.get("arms", [])]
        limits = Limits(**config.get("limits", {}))
    except (TypeError, KeyError) as e:
        raise ConfigError(f"arms or limits: {e}") from None
    extra = {k: config[k] for k in ("keys", "expected_jobs") if k in config}
    return JobTable(arms, prompts, limits, **extra, **config.get("sharding", {})).check()


def expand(values: dict[str, str]) -> dict[str, str]:
    """Resolve ${name} references among the values; a cycle or an unknown name is an error."""
    out: dict[str, str] = {}

    def resolve(key: str, path: tuple[str, ...]) -> str:
        if key in path:
            raise ConfigError(f"paths: {' -> '.join((*path, key))} is a cycle")
        if key not in values:
            raise ConfigError(f"paths: {path[-1]} refers to unknown {key}")
        if key not in out:
            out[key] = re.sub(r"\$\{(\w+)\}", lambda m: resolve(m[1], (*path, key)), values[key])
        return out[key]

    for key in values:
        resolve(key, ())
    return out


def parse_env(text: str) -> dict[str, str]:
    """KEY=VALUE lines; comments and blank lines are skipped, nothing is evaluated."""
    found = {}
    for line in text.splitlines():
        line = line.strip()
        if line and not line.startswith("#") and "=" in line:
            key, value = line.split("=", 1)
            found[key.strip().removeprefix("export ").strip()] = value.strip().strip("'\"")
    return found


def placeholders(text: str, pattern: str = r"<[A-Z][A-Z0-9_ ]+>|\bTODO\b|\bFIXME\b|\bCHANGE_?ME\b") -> list[tuple[int, str]]:
    """Unfilled values in a config text: line numbers and what was found."""
    return [(n, m.group()) for n, line in enumerate(text.splitlines(), 1) for m in re.finditer(pattern, line)]


def check_architecture(found: str, allowed: list[str]) -> None:
    """Refuse a GPU that a job may not run on; call it before a model is loaded."""
    if architecture(found, allowed) == "fail":
        raise ConfigError(f"GPU {found} is none of {allowed}")


def architecture(found: str, allowed: list[str]) -> str:
    """ok for a listed compute capability, warn for the same major version, else fail."""
    if found in allowed:
        return "ok"
    return "warn" if found.split(".")[0] in {a.split(".")[0] for a in allowed} else "fail"
