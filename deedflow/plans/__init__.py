"""Named queries: each module registers its plans in deedflow.catalog."""

from importlib import import_module

MODULES = ("matching", "timelines", "tables", "basics", "stored", "maintained", "pages", "files")


def load_all() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")
