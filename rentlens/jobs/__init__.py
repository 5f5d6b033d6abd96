"""Jobs for ``spark-submit``: ``python -m rentlens.jobs.pipeline`` and ``python -m rentlens.jobs.train``."""
