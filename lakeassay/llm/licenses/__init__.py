"""The texts that license scans look for."""

from importlib.resources import files


def standard_templates() -> dict[str, str]:
    """Licenses, their customary notices and one-line namings, by name. Phrases in [[ ]] are those that tell a license from others."""
    parts = files(__name__).joinpath("templates.txt").read_text("utf-8").split("== ")[1:]
    return {name.strip(): text.strip() for name, _, text in (p.partition("\n") for p in parts)}
