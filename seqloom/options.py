"""Job options: one immutable, validated value object."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields

# The options that must be positive, and those that must not be negative.
POSITIVE = (
    "total_documents",
    "chunk_size",
    "context_length",
    "batch_size",
    "epochs",
    "log_every_steps",
    "metrics_every_steps",
    "metric_smoothing_window",
    "max_plot_points",
)
NON_NEGATIVE = (
    "shuffle_buffer",
    "max_steps",
    "early_stop_step",
    "early_stop_patience_steps",
    "early_stop_min_delta",
    "early_stop_warmup_steps",
    "save_every_steps",
    "best_checkpoint_min_delta",
    "plot_every_steps",
    "histogram_every_steps",
)
MODES = ("early_stop_mode", "best_checkpoint_mode", "threshold_checkpoint_mode")


@dataclass(frozen=True)
class RunOptions:
    """Options of one run. Default values are fixed values of the command line being replaced."""

    # corpus
    dataset_name: str = "wikimedia/wikipedia"
    dataset_config: str | None = "20231101.en"
    dataset_split: str = "train"
    text_column: str = "text"
    total_documents: int = 100_000
    chunk_size: int = 10_000
    streaming: bool = True
    shuffle_buffer: int = 10_000
    seed: int = 42
    # sequences and batches
    context_length: int = 1024
    batch_size: int = 8
    epochs: int = 1
    # steps
    output_dir: str = "outputs/chunked_pretrain"
    learning_rate: float = 2e-4
    max_grad_norm: float = 1.0
    log_every_steps: int = 10
    max_steps: int = 0
    early_stop_step: int = 0
    resume_from: str | None = None
    # metric-based early stopping
    early_stop_metric: str = "train_loss"
    early_stop_mode: str = "min"
    early_stop_threshold: float | None = None
    early_stop_patience_steps: int = 0
    early_stop_min_delta: float = 0.0
    early_stop_warmup_steps: int = 0
    # checkpoint catalogue
    save_every_steps: int = 1_000
    save_each_chunk: bool = True
    save_best_checkpoint: bool = True
    best_checkpoint_metric: str = "train_loss"
    best_checkpoint_mode: str = "min"
    best_checkpoint_min_delta: float = 0.0
    save_threshold_checkpoint: bool = False
    threshold_checkpoint_metric: str = "train_loss"
    threshold_checkpoint_value: float | None = None
    threshold_checkpoint_mode: str = "min"
    threshold_checkpoint_once: bool = True
    # metric series
    metrics_every_steps: int = 10
    metric_smoothing_window: int = 20
    jsonl_metrics: bool = True
    tensorboard: bool = True
    save_plots: bool = True
    plot_every_steps: int = 500
    plot_metrics: str = (
        "train_loss,perplexity,grad_norm,learning_rate,"
        "tokens_per_second,samples_per_second,"
        "gpu_allocated_gb,gpu_reserved_gb,gpu_peak_allocated_gb"
    )
    max_plot_points: int = 5_000
    log_parameter_norm: bool = False
    histogram_every_steps: int = 0

    def __post_init__(self) -> None:
        for name in ("dataset_config", "resume_from"):
            if getattr(self, name) == "":
                object.__setattr__(self, name, None)
        for name in POSITIVE:
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        for name in NON_NEGATIVE:
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")
        for name in MODES:
            if getattr(self, name) not in ("min", "max"):
                raise ValueError(f"{name} must be 'min' or 'max'")
        if self.learning_rate <= 0:
            raise ValueError("learning_rate must be positive")
        if self.max_grad_norm <= 0:
            raise ValueError("max_grad_norm must be positive")
        if not self.plot_metric_names:
            raise ValueError("plot_metrics names no metric")
        if self.save_threshold_checkpoint and self.threshold_checkpoint_value is None:
            raise ValueError(
                "save_threshold_checkpoint needs a threshold_checkpoint_value"
            )
        if self.histogram_every_steps > 0 and not self.tensorboard:
            raise ValueError("histogram_every_steps needs tensorboard")
        if self.plot_every_steps > 0 and not self.save_plots:
            raise ValueError("plot_every_steps needs save_plots")

    @property
    def plot_metric_names(self) -> list[str]:
        return [name.strip() for name in self.plot_metrics.split(",") if name.strip()]

    def to_dict(self) -> dict[str, object]:
        return asdict(self)

    @classmethod
    def from_dict(cls, values: dict[str, object]) -> "RunOptions":
        known = {field.name for field in fields(cls)}
        unknown = sorted(set(values) - known)
        if unknown:
            raise ValueError(f"unknown options: {', '.join(unknown)}")
        return cls(**values)
