"""Request-level features: status classes, port, protocol, payload, path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from botlens import values
from botlens.functions.agents import flag


def is_client_error(status: Column) -> Column:
    return flag(status.between(400, 499))


def is_server_error(status: Column) -> Column:
    return flag(status.between(500, 599))


def is_failure(status: Column) -> Column:
    """Any status from 400 up; 600 and above belong to neither error class."""
    return flag(status >= 400)


def is_success(status: Column) -> Column:
    return flag(status.between(200, 299))


def port_or_default(port: Column, path: Column) -> Column:
    by_path = F.when(path.startswith("https"), F.lit(443)).otherwise(F.lit(80))
    return F.coalesce(port, by_path)


def protocol_code(protocol: Column) -> Column:
    """0 for TCP or unknown, 1 for anything else."""
    return flag(F.lower(protocol) != "tcp")


def request_type_code(request_type: Column, port: Column) -> Column:
    """1 for HTTPS; where the type is unknown the port decides."""
    return flag(F.coalesce(F.lower(request_type) == "https", port == 443))


def is_encrypted(port: Column, request_type: Column) -> Column:
    return flag((port == 443) | (request_type == 1))


def payload(bytes_sent: Column) -> Column:
    return bytes_sent.cast("double")


def is_admin_path(path: Column, pattern: str = values.ADMIN_PATH_PATTERN) -> Column:
    return flag(path.rlike(pattern))


def is_probe_path(path: Column) -> Column:
    return flag(path.isin(*values.PROBE_PATHS))
