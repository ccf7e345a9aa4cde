"""Argument limits shared by the request-like operators."""


def at_most(name: str, value: int, limit: int) -> int:
    if value < 0 or value > limit:
        raise ValueError(f"{name} must be between 0 and {limit}, not {value}")
    return value
