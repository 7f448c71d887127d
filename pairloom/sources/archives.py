"""Driver-side downloads: checksums, bucket addresses, archives that stay inside their folder."""

from __future__ import annotations

import hashlib
import os
import tarfile
import zipfile
from urllib.parse import quote
from urllib.request import urlopen

BLOCK = 1 << 20


def sha256_of(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(BLOCK):
            digest.update(block)
    return digest.hexdigest()


def web_address(url: str) -> str:
    """gs:// addresses as https; others as they are."""
    if not url.startswith("gs://"):
        return url
    bucket, _, name = url[5:].partition("/")
    return f"https://storage.googleapis.com/{bucket}/{quote(name)}"


def download(url: str, path: str, sha256: str | None = None, force: bool = False) -> str:
    """Fetches a file once; a wrong checksum removes it again."""
    if os.path.exists(path) and not force:
        raise FileExistsError(path)
    part = f"{path}.part"
    with urlopen(web_address(url)) as src, open(part, "wb") as out:  # noqa: S310 - the caller's address
        while block := src.read(BLOCK):
            out.write(block)
    if sha256 and sha256_of(part) != sha256.lower():
        os.remove(part)
        raise ValueError(f"{url}: the checksum doesn't match")
    os.replace(part, path)
    return path


def extract(archive: str, folder: str) -> list[str]:
    """Unpacks tar or zip; a member that would leave the folder, or a link, is an error before anything is written."""
    top = os.path.realpath(folder)

    def check(name: str) -> str:
        path = os.path.realpath(os.path.join(top, name))
        if path != top and not path.startswith(top + os.sep):
            raise ValueError(f"{name!r} leaves the folder")
        return path

    if zipfile.is_zipfile(archive):
        with zipfile.ZipFile(archive) as z:
            names = z.namelist()
            paths = [check(n) for n in names]
            z.extractall(top)
        return paths
    with tarfile.open(archive) as t:
        members = t.getmembers()
        for m in members:
            check(m.name)
            if not (m.isfile() or m.isdir()):
                raise ValueError(f"{m.name!r} is neither file nor folder")
        t.extractall(top, filter="data")
    return [os.path.join(top, m.name) for m in members]
