"""Session helpers."""

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

from millrace.session import ship


def test_threads_that_ship_at_once_send_one_archive():
    """Tables written side by side each send the package; Spark refuses a second file of one name."""
    sent = []

    def add(path):
        time.sleep(0.05)
        sent.append(path)

    spark = SimpleNamespace(sparkContext=SimpleNamespace(applicationId=f"app-{uuid.uuid4().hex}", addPyFile=add))
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(ship, [spark] * 8))
    assert len(sent) == 1
