"""Entity keys: the same operators run per house or per plug."""

HOUSE = ("house_id",)
PLUG = ("house_id", "household_id", "plug_id")


def keys_of(level: str) -> tuple[str, ...]:
    if level == "house":
        return HOUSE
    if level == "plug":
        return PLUG
    raise ValueError(f"level must be 'house' or 'plug', not {level!r}")
