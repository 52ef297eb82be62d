"""Query plans: fixtures derived from the driver tables, registered queries and oracles,
and the end-to-end training programs."""


def load_all():
    """Import every query module so the registry is complete."""
    import importlib
    for mod in ("queries_prep", "queries_sources", "queries_scoring", "queries_training", "programs"):
        try:
            importlib.import_module(f"{__name__}.{mod}")
        except ModuleNotFoundError as e:
            if e.name != f"{__name__}.{mod}":
                raise
