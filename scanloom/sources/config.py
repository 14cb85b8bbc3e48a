"""Device profiles: settings by host name, with an environment variable first."""

from __future__ import annotations

import os
import socket

from ..functions.naming import host_key


def profile_name(patterns: dict[str, str], host: str | None = None, env: str = "DEVICE_NAME") -> str:
    """The variable's value, else the name of the first pattern in the host name, else the host name."""
    if os.environ.get(env):
        return os.environ[env]
    host = host_key(host or socket.gethostname())
    return next((name for pattern, name in patterns.items() if pattern in host), host)


def profile(config: dict, host: str | None = None) -> dict:
    """Global settings overlaid by those of the device."""
    name = profile_name(config.get("patterns", {}), host)
    if name not in config.get("devices", {}):
        raise KeyError(f"no profile for {name}")
    return config.get("global", {}) | config["devices"][name]
