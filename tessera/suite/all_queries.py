"""Import every query module so the registry is complete."""
from tessera.suite import metrics  # noqa: F401
from tessera.suite import calendar_q  # noqa: F401
from tessera.suite import series_q  # noqa: F401
from tessera.suite import text_q  # noqa: F401
from tessera.suite import io_seg_q  # noqa: F401
