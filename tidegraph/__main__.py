"""`python -m tidegraph SETTINGS.toml STORE [RECORDED]`: runs the crawl until interrupted.

STORE is the folder of the tables, RECORDED one of recorded relays to replay instead of
asking the live ones.  Variables `TIDEGRAPH__NAME` override the settings.
"""

from __future__ import annotations

import signal
import sys

from pyspark.sql import SparkSession

from .config import load
from .plans.daemon import assembled, serve, start_logging
from .sources import relay, websocket


def main(arguments: list[str]) -> int:
    if len(arguments) not in (2, 3):
        print(__doc__, file=sys.stderr)
        return 2
    config = load(arguments[0], "TIDEGRAPH").validate()
    start_logging(config.log_level, config.log_format)
    spark = SparkSession.builder.appName("tidegraph").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    daemon = assembled(spark, config, arguments[1], relay.recorded(arguments[2]) if len(arguments) == 3 else websocket.connect)
    for s in (signal.SIGINT, signal.SIGTERM):
        signal.signal(s, lambda *_: daemon.stop.set())
    server = serve(daemon, config.metrics_addr)
    try:
        daemon.run()
    finally:
        server.shutdown()
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
