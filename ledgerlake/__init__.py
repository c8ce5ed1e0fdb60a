"""ledgerlake — a PySpark-native margin / cost-gap data mart.

Plain functions over Spark ``DataFrame`` / ``Column``: every operator builds a
lazy logical plan that Catalyst optimises; nothing is collected to the driver
except small gate decisions (empty input, column-set checks).
"""

from ledgerlake.session import build_session, configure_session, checkpoint_dir

__all__ = ["build_session", "configure_session", "checkpoint_dir"]
