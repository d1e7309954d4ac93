"""What stands around a run: one at a time, the device, uploads, and whether a summary has what a view of it needs."""

from __future__ import annotations

import base64
import binascii
import contextlib
import os
import threading
from collections.abc import Iterator

_RUNNING = threading.Lock()


class Busy(RuntimeError):
    """Another run of this process hasn't ended."""


@contextlib.contextmanager
def exclusive() -> Iterator[None]:
    """One run at a time; a second one is refused at once."""
    if not _RUNNING.acquire(blocking=False):
        raise Busy("a run is going on")
    try:
        yield
    finally:
        _RUNNING.release()


def device(wanted: str | None = None, available: bool = False) -> str:
    """cpu or cuda: as wanted, else as LAMELLA_DEVICE says, else cuda where it is available; never an error, so an unknown or missing device is the cpu."""
    choice = (wanted or os.environ.get("LAMELLA_DEVICE") or "auto").strip().lower()
    return "cuda" if available and choice in ("auto", "cuda") else "cpu"


def require_device(wanted: str, available: bool) -> str:
    """As device(), but cuda that isn't there is an error where it was asked for by name."""
    if wanted == "cuda" and not available:
        raise RuntimeError("cuda was asked for and isn't available")
    return device(wanted, available)


class Refused(ValueError):
    """An upload that can't be taken, with the reason."""


#: What an upload may hold.
MOST_FILES, MOST_BYTES, MOST_NAME = 10, 30 * 1024 * 1024, 200


def upload_name(raw: str) -> str:
    """A file's own name, without folders of either kind."""
    name = raw.replace("\\", "/").rpartition("/")[2].strip()
    bad = name in ("", ".", "..") or len(name) > MOST_NAME or not name.isprintable()
    if bad:
        raise Refused("a file's name can't be used")
    if name[-4:].lower() != ".pdf":
        raise Refused(f"{name}: only .pdf files are taken")
    return name


def upload(files: list[dict[str, str]]) -> dict[str, bytes]:
    """Contents by name of [{"name", "data" in base64}]; names differ in more than case, contents begin as PDF files do."""
    if not 1 <= len(files) <= MOST_FILES:
        raise Refused(f"an upload has 1 to {MOST_FILES} files")
    out: dict[str, bytes] = {}
    for item in files:
        name = upload_name(item.get("name", ""))
        try:
            data = base64.b64decode(item.get("data", ""), validate=True)
        except binascii.Error:
            raise Refused(f"{name}: not base64") from None
        if data[:4] != b"%PDF":
            raise Refused(f"{name}: not a PDF file")
        if name.casefold() in {x.casefold() for x in out}:
            raise Refused(f"{name}: twice")
        out[name] = data
    if sum(map(len, out.values())) > MOST_BYTES:
        raise Refused(f"an upload has at most {MOST_BYTES >> 20} MB")
    return out


#: Views of a summary, and the keys each needs.
VIEWS = {"stages": ("stages",), "purity": ("before", "after"), "entities": ("entity_totals",), "tokens": ("files", "tokens"), "filters": ("overlap", "per_filter")}


def views(summary: dict) -> list[str]:
    """The views whose keys are all there and not null."""
    return [v for v, keys in VIEWS.items() if all(summary.get(k) is not None for k in keys)]
