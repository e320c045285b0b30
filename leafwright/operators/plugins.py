"""Models as plug-ins: a detector or recognizer is a callable that the caller brings; none is built in.

``load`` runs once in every worker before its first row, so that a checkpoint is loaded once and not per
page. A model's failure on one row becomes that row's ``error``; results are never made up.
"""

from __future__ import annotations

import multiprocessing
import os
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as Late

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOKENS, BUDGET_S = 2048, 120.0
#: A call that has not answered after so many budgets is killed, and its page is to be stepped over from then on.
HARD = 2.0
SKIP = "TIMEOUT_SKIP"


class ServerGone(RuntimeError):
    """The server behind a model did not come back; the run ends rather than write empty results."""


class _Watched:
    """A model in a process of its own, which can be killed when it hangs."""

    def __init__(self, load: Callable[[], Callable[[dict], str]], budget_s: float):
        self.load, self.budget_s, self.process = load, budget_s, None

    def _start(self) -> None:
        context = multiprocessing.get_context("fork")
        self.pipe, far = context.Pipe()
        self.process = context.Process(target=self._serve, args=(far,), daemon=True)
        self.process.start()
        far.close()

    def _serve(self, pipe) -> None:
        try:
            model, pool = self.load(), ThreadPoolExecutor(1)
            while True:
                row = pipe.recv()
                try:
                    answer = ("text", pool.submit(model, row).result(timeout=self.budget_s))
                except Late:
                    answer, pool = ("late", ""), ThreadPoolExecutor(1)  # the late call keeps its own thread
                except ConnectionError as e:
                    answer = ("gone", f"{type(e).__name__}: {e}")
                except Exception as e:
                    answer = ("error", f"{type(e).__name__}: {e}")
                pipe.send(answer)
        except EOFError:
            pass
        except BaseException as e:
            pipe.send(("error", f"{type(e).__name__}: {e}"))
        os._exit(0)

    def __call__(self, row: dict) -> tuple[str, str]:
        if self.process is None or not self.process.is_alive():
            self._start()
        try:
            self.pipe.send(row)
            if self.pipe.poll(HARD * self.budget_s):
                return self.pipe.recv()
        except (EOFError, OSError) as e:
            self.stop()
            return "error", f"the model's process ended: {type(e).__name__}"
        self.stop()
        return "skip", SKIP

    def stop(self) -> None:
        if self.process is not None:
            self.process.kill()
            self.process.join()
            self.pipe.close()
            self.process = None


def recognize(
    tasks: DataFrame,
    load: Callable[[], Callable[[dict], str]],
    budget_s: float = BUDGET_S,
    retries: int = 0,
    wait_s: float = 1.0,
    alive: Callable[[], bool] | None = None,
    server_wait_s: float = 300.0,
) -> DataFrame:
    """Tasks with ``text`` and ``error``.

    A task over its budget gets the empty text. One that does not come back even then, because the model hangs, is
    killed after ``HARD`` budgets and has the error ``TIMEOUT_SKIP``; ``skipped`` makes the table of such pages. One
    that fails is tried again ``retries`` times, each time after a longer wait, and then has an error and no text.
    A ``ConnectionError`` means that the model's server is gone: ``alive`` is asked until it is back, and the same
    task goes on; if it is not back after ``server_wait_s``, the run ends with ``ServerGone``.
    """
    names = tasks.columns

    def back() -> bool:
        end = time.monotonic() + server_wait_s
        while time.monotonic() < end:
            try:
                if alive():
                    return True
            except Exception:  # not yet
                pass
            time.sleep(min(wait_s, 5.0))
        return False

    def one(model: _Watched, row: dict) -> tuple[str | None, str | None]:
        tried = 0
        while True:
            kind, value = model(row)
            if kind in ("text", "late"):
                return value, None
            if kind == "skip":
                return None, value
            if kind == "gone" and alive is not None:
                if not back():
                    raise ServerGone(f"not back within {server_wait_s} s: {value}")
                continue
            tried += 1
            if tried > retries:
                return None, value
            time.sleep(wait_s * tried)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _Watched(load, budget_s)
        try:
            for b in batches:
                got = [one(model, row) for row in b.to_dict("records")]
                b["text"], b["error"] = [t for t, _ in got], [e for _, e in got]
                yield b[[*names, "text", "error"]]
        finally:
            model.stop()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tasks.schema)
    return tasks.mapInPandas(run, f"{fields}, text string, error string")


def skipped(results: DataFrame, page: str = "page_id") -> DataFrame:
    """(page, n_regions): pages with a region on which the model hung; resumed runs leave them out."""
    return results.where(F.col("error") == SKIP).groupBy(page).agg(F.count(F.lit(1)).alias("n_regions"))


def detect(images: DataFrame, load: Callable[[], Callable[[bytes, int, int, int], list[list[float]]]], page: str = "page_id") -> DataFrame:
    """(page, values array<float>, bbox_num, error): the flat rows of seven values that ``layout.decode`` reads."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for b in batches:
            out = []
            for p, data, h, w, n in zip(b[page], b["data"], b["height"], b["width"], b["nChannels"]):
                try:
                    rows = model(bytes(data), int(h), int(w), int(n))
                    out.append((p, [float(v) for r in rows for v in r], len(rows), None))
                except Exception as e:
                    out.append((p, [], 0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=[page, "values", "bbox_num", "error"])

    kind = images.schema[page].dataType.simpleString()
    return images.select(page, "data", "height", "width", "nChannels").mapInPandas(run, f"{page} {kind}, values array<float>, bbox_num int, error string")
