import dataclasses

import pytest

from seqloom import RunOptions


def test_defaults():
    options = RunOptions()
    assert (options.chunk_size, options.context_length, options.batch_size) == (10_000, 1024, 8)
    assert len(options.plot_metric_names) == 9
    assert RunOptions.from_dict(options.to_dict()) == options


def test_immutable():
    with pytest.raises(dataclasses.FrozenInstanceError):
        RunOptions().seed = 1


@pytest.mark.parametrize("name", ["chunk_size", "epochs", "metrics_every_steps", "max_plot_points"])
def test_positive(name):
    with pytest.raises(ValueError, match=f"{name} must be positive"):
        RunOptions(**{name: 0})


@pytest.mark.parametrize("name", ["shuffle_buffer", "max_steps", "early_stop_min_delta"])
def test_non_negative(name):
    RunOptions(**{name: 0})
    with pytest.raises(ValueError, match=f"{name} must not be negative"):
        RunOptions(**{name: -1})


def test_dependencies():
    with pytest.raises(ValueError, match="threshold_checkpoint_value"):
        RunOptions(save_threshold_checkpoint=True)
    with pytest.raises(ValueError, match="needs tensorboard"):
        RunOptions(histogram_every_steps=5, tensorboard=False)
    with pytest.raises(ValueError, match="needs save_plots"):
        RunOptions(save_plots=False)
    with pytest.raises(ValueError, match="mode"):
        RunOptions(early_stop_mode="avg")
    with pytest.raises(ValueError, match="plot_metrics"):
        RunOptions(plot_metrics=" , ")
    with pytest.raises(ValueError, match="unknown options: colour"):
        RunOptions.from_dict({"colour": 1})


def test_empty_strings_mean_none():
    options = RunOptions(dataset_config="", resume_from="")
    assert options.dataset_config is None and options.resume_from is None
