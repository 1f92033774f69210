"""All registered queries, by family. Importing this package fills the registry."""

from . import (  # noqa: F401
    anomaly, cleaning, core, incremental, quality, quarantine, reporting, sinks, validation,
)
