"""Makes the library importable in Python workers that don't start in its folder."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from pathlib import Path

_shipped: set[str] = set()


def ship(spark) -> None:
    """Adds the package, zipped, to the application's Python files; once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="keelson-")) / "keelson.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)


def shipped(query):
    @functools.wraps(query)
    def run(spark, *args):
        ship(spark)
        return query(spark, *args)

    return run
