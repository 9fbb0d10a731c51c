"""Who may load: a lease with an expiry, taken before any work.

    <root>/leases/n=<number>/…json

The highest record says who holds the lease and until when. A load takes the next number;
a second one that starts meanwhile is refused at once. A load renews its lease as it goes
on and gives it back with a last record. The lease of a load that died runs out and is
taken over; if the load was only slow, it notices before it publishes and gives up. Hosts
must agree on the time to within the length of a lease.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from obstar.sources import numbered

_RECORD = "holder STRING, token STRING, expires DOUBLE, released BOOLEAN"
SECONDS = 3600.0


class LeaseHeld(RuntimeError):
    """Another load holds the lease."""


def _folder(root: str) -> str:
    return f"{root}/leases"


@dataclass
class Lease:
    """The lease as its holder has it."""

    spark: SparkSession
    root: str
    holder: str
    seconds: float
    number: int = 0
    expires: float = 0.0

    def _write(self, number: int, released: bool = False) -> None:
        token, expires = uuid.uuid4().hex, time.time() + self.seconds
        record = (self.holder, token, expires, released)
        try:
            numbered.append(self.spark, _folder(self.root), number, record, _RECORD, token)
        except numbered.Taken as taken:
            raise LeaseHeld(f"the lease of {self.root} was taken by another load") from taken
        self.number, self.expires = number, expires

    def renew(self) -> None:
        """Hold on; a lease with most of its time left is not written again.

        Fails if another load has taken it over.
        """
        if numbered.latest(self.spark, _folder(self.root)) != self.number:
            raise LeaseHeld(f"the lease of {self.root} ran out and was taken over")
        if time.time() > self.expires - self.seconds / 2:
            self._write(self.number + 1)

    def end(self) -> None:
        """Let the time of the lease be over at once, as after its holder died."""
        self.seconds = 0.0
        self._write(self.number + 1)

    def release(self) -> None:
        """Give the lease back, if it is still this load's."""
        if numbered.latest(self.spark, _folder(self.root)) == self.number:
            self._write(self.number + 1, released=True)


def take(spark: SparkSession, root: str, holder: str, seconds: float = SECONDS) -> Lease:
    """Take the lease, or fail with LeaseHeld while another load has it."""
    lease = Lease(spark, root, holder, seconds)
    last = numbered.latest(spark, _folder(root))
    held = numbered.read(spark, _folder(root), last, _RECORD) if last else None
    if held and not held["released"] and held["expires"] > time.time():
        left = held["expires"] - time.time()
        raise LeaseHeld(f"{held['holder']} holds the lease of {root} for another {left:.0f} s at most")
    lease._write(last + 1)
    return lease
