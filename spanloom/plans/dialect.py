"""The few expressions that Spark SQL and DuckDB spell differently."""

from __future__ import annotations


class SparkText:
    """Spark SQL spelling."""

    name = "spark"

    def hex(self, n: str, width: int, pad: str = "0") -> str:
        return f"lpad(lower(hex({n})), {width}, '{pad}')"

    def micros(self, t: str) -> str:
        return f"unix_micros(cast({t} as timestamp))"

    def seconds(self, t: str) -> str:
        return f"unix_seconds(cast({t} as timestamp))"

    def json_text(self, c: str, key: str) -> str:
        return f"get_json_object({c}, '$.{key}')"

    def utf8(self, s: str) -> str:
        return f"encode({s}, 'UTF-8')"

    def base64(self, s: str) -> str:
        return f"base64(encode({s}, 'UTF-8'))"

    def blob(self, hexdigits: str) -> str:
        return f"X'{hexdigits}'"

    def timestamp(self, t: str) -> str:
        return f"cast({t} as timestamp)"


class DuckText:
    """DuckDB spelling."""

    name = "duckdb"

    def hex(self, n: str, width: int, pad: str = "0") -> str:
        return f"lpad(printf('%x', {n}), {width}, '{pad}')"

    def micros(self, t: str) -> str:
        return f"epoch_us({t})"

    def seconds(self, t: str) -> str:
        return f"cast(floor(epoch({t})) as bigint)"

    def json_text(self, c: str, key: str) -> str:
        return f"json_extract_string({c}, '$.{key}')"

    def utf8(self, s: str) -> str:
        return f"encode({s})"

    def base64(self, s: str) -> str:
        return f"to_base64(encode({s}))"

    def blob(self, hexdigits: str) -> str:
        return f"unhex('{hexdigits}')"

    def timestamp(self, t: str) -> str:
        return t


SPARK, DUCK = SparkText(), DuckText()
