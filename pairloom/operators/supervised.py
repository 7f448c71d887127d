"""A model in a child process of a task: a call that hangs, or ends the process, costs that process and nothing else."""

from __future__ import annotations

import os
import pickle
import select
import signal
import struct
import subprocess
import sys
import time
from collections.abc import Callable

from pyspark import cloudpickle

_CHILD = "import sys; from pairloom.operators.supervised import serve; serve(int(sys.argv[1]), int(sys.argv[2]))"


class Hung(TimeoutError):
    """A call took too long and its process was killed."""


class Died(RuntimeError):
    """The process ended during a call."""


def _send(to: int, payload: bytes) -> None:
    data = memoryview(struct.pack("<q", len(payload)) + payload)
    while data:
        data = data[os.write(to, data) :]


def _read(source: int, n: int, until: float | None) -> bytes:
    out = bytearray()
    while len(out) < n:
        if until is not None and not select.select([source], [], [], max(0.0, until - time.monotonic()))[0]:
            raise Hung
        part = os.read(source, min(n - len(out), 1 << 20))
        if not part:
            raise Died("the model's process ended")
        out += part
    return bytes(out)


def _receive(source: int, until: float | None = None) -> bytes:
    return _read(source, struct.unpack("<q", _read(source, 8, until))[0], until)


def serve(source: int, to: int) -> None:
    """The child: makes the model, then answers calls until its input ends."""
    def answer(run: Callable[[], object]) -> None:
        try:
            said = (True, run())
        except Exception as e:  # noqa: BLE001 - the parent raises it
            said = (False, str(e))
        _send(to, pickle.dumps(said, protocol=5))

    model: list = []
    try:
        factory = cloudpickle.loads(_receive(source))
        answer(lambda: model.append(factory()))
        while True:
            texts = pickle.loads(_receive(source))
            answer(lambda: model[0](texts))
    except Died:  # the parent has gone, or wants no more
        pass


class Supervised:
    """A function from texts to matrices that runs in a process of its own, made at the first call and after each kill."""

    def __init__(self, factory: Callable[[], Callable[[list[str]], list]], seconds: float, load_seconds: float = 600.0) -> None:
        self.factory, self.seconds, self.load_seconds, self.child = cloudpickle.dumps(factory), seconds, load_seconds, None

    def _start(self) -> None:
        (child_in, self.to), (self.source, child_out) = os.pipe(), os.pipe()
        env = os.environ | {"PYTHONPATH": os.pathsep.join(p for p in sys.path if p)}
        # A session of its own, so that what the model starts is killed with it.
        self.child = subprocess.Popen([sys.executable, "-c", _CHILD, str(child_in), str(child_out)], pass_fds=(child_in, child_out), env=env, stdin=subprocess.DEVNULL, stdout=subprocess.DEVNULL, start_new_session=True)
        os.close(child_in)
        os.close(child_out)
        self._ask(self.factory, self.load_seconds)

    def _ask(self, payload: bytes, seconds: float) -> object:
        try:
            _send(self.to, payload)
            good, said = pickle.loads(_receive(self.source, time.monotonic() + seconds))
        except Hung:
            self.close()
            raise Hung(f"more than {seconds} seconds") from None
        except (Died, BrokenPipeError):
            self.close()
            raise Died("the model's process ended") from None
        if not good:
            raise RuntimeError(said)
        return said

    def __call__(self, texts: list[str]) -> list:
        if self.child is None:
            self._start()
        return self._ask(pickle.dumps(texts), self.seconds)

    def close(self) -> None:
        """Kills the process with all that it has started."""
        if self.child is not None:
            try:
                os.killpg(self.child.pid, signal.SIGKILL)
            except ProcessLookupError:
                pass
            self.child.wait()
            os.close(self.to)
            os.close(self.source)
            self.child = None


class Guarded:
    """A model called on batches: (result, error) for each item. A batch that fails is halved until single items are left.

    Those carry the error; the model is made anew after each failure. With `seconds` it runs in a child process, which is
    killed when a call takes longer. `finish` is applied to each result, and its failures count as the item's.
    """

    def __init__(self, factory: Callable[[], Callable[[list], list]], seconds: float | None = None, finish: Callable = lambda x: x) -> None:
        self.made = factory if seconds is None else lambda: Supervised(factory, seconds)
        self.finish, self.model = finish, self.made()

    def __call__(self, items: list) -> list[tuple]:
        try:
            return [(self.finish(x), None) for x in self.model(items)]
        except Exception as e:  # noqa: BLE001 - becomes the item's error
            self.close()
            self.model = self.made()
            if len(items) == 1:
                return [(None, str(e))]
            half = len(items) // 2
            return self(items[:half]) + self(items[half:])

    def close(self) -> None:
        if isinstance(self.model, Supervised):
            self.model.close()

    def __enter__(self) -> Guarded:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()
