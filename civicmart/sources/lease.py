"""One writer at a time in a warehouse.

The right to write is a numbered file below the warehouse. Who creates the file that follows the last one holds it;
creating is exclusive, so of two that try one fails. A holder shows that it lives by writing its file again and again
and ends by writing that it is released. A holder that shows no sign of life for long enough has died, and the next
one creates the file that follows. No clocks of two machines are compared: the one who waits measures how long the
file has stayed the same. A holder that was only slow finds the later file and stops before it publishes anything.

The store must create files exclusively, as HDFS and (shared) POSIX folders do.
"""

from __future__ import annotations

import os
import threading
import time
import uuid
from contextlib import suppress

from pyspark.sql import SparkSession

RELEASED = "released"
#: Seconds without a sign of life after which a holder counts as dead, and between two signs.
PATIENCE, BEAT = 120.0, 10.0


class WarehouseBusy(RuntimeError):
    """Another load held the warehouse for as long as this one was ready to wait."""


class LeaseLost(RuntimeError):
    """Another load has taken over."""


class Notes:
    """Small text files in a folder that the driver reaches through Spark's file systems."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm = spark.sparkContext._jvm
        self.folder = self.jvm.org.apache.hadoop.fs.Path(folder)
        self.files = self.folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        # The local file system has exclusive creation in the operating system only.
        self.local = self.folder.toUri().getPath() if self.files.getScheme() == "file" else None
        if self.local:
            os.makedirs(self.local, exist_ok=True)
        else:
            self.files.mkdirs(self.folder)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.folder, name)

    def names(self) -> list[str]:
        if self.local:
            return os.listdir(self.local)
        return [status.getPath().getName() for status in self.files.listStatus(self.folder)]

    def create(self, name: str, text: str) -> bool:
        """False if the file is there already."""
        try:
            if self.local:
                with open(f"{self.local}/{name}", "x") as out:
                    out.write(text)
            else:
                self._write(name, text, False)
        except Exception:
            if name in self.names():
                return False
            raise
        return True

    def write(self, name: str, text: str) -> None:
        if self.local:
            part = f"{self.local}/.{uuid.uuid4().hex}"
            with open(part, "w") as out:
                out.write(text)
            os.replace(part, f"{self.local}/{name}")
        else:
            self._write(name, text, True)

    def _write(self, name: str, text: str, over: bool) -> None:
        out = self.files.create(self._at(name), over)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str | None:
        """None if the file is gone."""
        try:
            if self.local:
                with open(f"{self.local}/{name}") as held:
                    return held.read()
            held = self.files.open(self._at(name))
            try:
                return self.jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
            finally:
                held.close()
        except Exception:
            if name not in self.names():
                return None
            raise

    def delete(self, name: str) -> None:
        if self.local:
            with suppress(FileNotFoundError):
                os.unlink(f"{self.local}/{name}")
        else:
            self.files.delete(self._at(name), False)


class Lease:
    """The right to write to one warehouse, from `take` to `release`."""

    def __init__(self, spark: SparkSession, root: str, patience: float = PATIENCE, beat: float = BEAT):
        self.notes = Notes(spark, f"{root}/_lease")
        self.patience, self.beat = patience, beat
        self.owner, self.number = uuid.uuid4().hex, 0
        self.ended = threading.Event()

    def _last(self) -> int:
        return max((int(n) for n in self.notes.names() if n.isdigit()), default=0)

    def _name(self, number: int) -> str:
        return f"{number:012d}"

    def take(self, wait: float) -> Lease:
        """Holds the lease, or raises `WarehouseBusy` after `wait` seconds."""
        until = time.monotonic() + wait
        seen, since = None, time.monotonic()
        while True:
            last = self._last()
            text = self.notes.read(self._name(last)) if last else RELEASED
            if (last, text) != seen:
                seen, since = (last, text), time.monotonic()
            dead = text is not None and time.monotonic() - since >= self.patience
            if (text == RELEASED or dead) and self.notes.create(self._name(last + 1), f"{self.owner} 0"):
                if self._last() == last + 1:
                    self.number = last + 1
                    break
                self.notes.delete(self._name(last + 1))  # later ones came and went since the folder was read
            if time.monotonic() >= until:
                raise WarehouseBusy(f"another load holds {self.notes.folder} ({text})")
            time.sleep(min(0.2, self.patience / 4))
        for name in self.notes.names():
            if name.isdigit() and int(name) < self.number:
                self.notes.delete(name)
        threading.Thread(target=self._live, daemon=True).start()
        return self

    def _live(self) -> None:
        beats = 0
        while not self.ended.wait(self.beat):
            beats += 1
            with suppress(Exception):  # a sign that fails is followed by the next one
                if self._last() != self.number:
                    return
                self.notes.write(self._name(self.number), f"{self.owner} {beats}")

    def check(self) -> None:
        """Raises if another load has taken over; called before anything is published."""
        if self._last() != self.number:
            raise LeaseLost(f"another load took over {self.notes.folder}")

    def release(self) -> None:
        self.ended.set()
        if self._last() == self.number:
            self.notes.write(self._name(self.number), RELEASED)
