"""tessera: sensor-stream analytics as Spark DataFrame plans.

Irregular sensor series are cleaned, de-duplicated, clipped to their
common time range, resampled onto a regular grid by linear
interpolation, aligned into multi-channel rows and cut into
count-based sliding windows; windows are normalised, split by subject,
profiled, scored by a pluggable model and evaluated, in batch and in
Structured Streaming.  Every operator is a ``DataFrame -> DataFrame``
function; nothing is collected to the driver on the data path.
"""

from tessera.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
