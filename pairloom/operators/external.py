"""External programs on batches of rows: structure search, structure letters, structure prediction.

The programs are not part of this repository. A task writes a batch to a folder of its own, runs the command there, and
reads back what it wrote; nothing of that folder is read by another task. What fails becomes the rows' error.
"""

from __future__ import annotations

import subprocess
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame

#: Rows of a run of the program.
BATCH = 1000


def fasta_text(rows: list[tuple[str, str]]) -> str:
    return "".join(f">{key}\n{text}\n" for key, text in rows)


def fasta_rows(text: str) -> dict[str, str]:
    """First words of headers -> sequences; of repeated ids the last."""
    out: dict[str, str] = {}
    for record in text.split(">")[1:]:
        head, _, body = record.partition("\n")
        if head.split():
            out[head.split()[0]] = "".join(body.split())
    return out


def run_program(df: DataFrame, key: str, text: str, command: list[str], read: Callable[[Path], dict[str, str]], write: Callable[[Path, list[tuple[str, str]]], None] | None = None, batch: int = BATCH, seconds: float | None = None) -> DataFrame:
    """(key, value, error) for each row (key and text as strings): the program's results by key.

    `{in}` and `{out}` in the command stand for the batch's input file (FASTA, unless `write` makes another) and its
    output, which `read` turns into values by key. A batch that fails is halved down to the single row that is to blame.
    """

    def once(rows: list[tuple[str, str]]) -> dict[str, str]:
        with tempfile.TemporaryDirectory() as folder:
            source, target = Path(folder, "in.fasta"), Path(folder, "out")
            (write or (lambda path, x: path.write_text(fasta_text(x))))(source, rows)
            done = subprocess.run([x.replace("{in}", str(source)).replace("{out}", str(target)) for x in command], cwd=folder, capture_output=True, text=True, timeout=seconds, check=False)
            if done.returncode:
                raise RuntimeError(f"status {done.returncode}: {done.stderr[-500:]}")
            if not target.exists():
                target.write_text(done.stdout)
            return read(target)

    def tried(rows: list[tuple[str, str]]) -> list[tuple[str, str | None, str | None]]:
        try:
            found = once(rows)
            return [(k, found.get(k), None if k in found else "no result") for k, _ in rows]
        except Exception as e:  # noqa: BLE001 - becomes the row's error
            if len(rows) == 1:
                return [(rows[0][0], None, str(e))]
            half = len(rows) // 2
            return tried(rows[:half]) + tried(rows[half:])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[str, str]] = []
        for frame in frames:
            held += list(zip(frame[key].astype(str), frame[text].fillna("").astype(str), strict=True))
            while len(held) >= batch:
                yield pd.DataFrame(tried(held[:batch]), columns=[key, "value", "error"])
                held = held[batch:]
        if held:
            yield pd.DataFrame(tried(held), columns=[key, "value", "error"])

    return df.select(key, text).mapInPandas(run, f"`{key}` string, value string, error string")


def structure_letters(structures: DataFrame, key: str, content: str, program: str, seconds: float | None = None) -> DataFrame:
    """(key, value, error): lower-case structure letters of structure files (their text), by a program called as `program {in} {out}`."""
    import json

    def write(path: Path, rows: list[tuple[str, str]]) -> None:
        names = {}
        for k, (identifier, body) in enumerate(rows):
            names[f"s{k}"] = identifier
            (path.parent / f"s{k}.pdb").write_text(body)
        path.write_text("\n".join(f"{path.parent}/{n}.pdb" for n in names))
        (path.parent / "names.json").write_text(json.dumps(names))

    def read(path: Path) -> dict[str, str]:
        names = json.loads((path.parent / "names.json").read_text())
        return {names[n]: s.lower() for n, s in fasta_rows(path.read_text()).items() if n in names}

    return run_program(structures, key, content, [program, "{in}", "{out}"], read, write, seconds=seconds)
