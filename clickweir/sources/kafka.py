"""Connection and authentication options of the Kafka connector."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

# Settings that may be written as $NAME and are then taken from the environment.
FROM_ENVIRONMENT = (
    "user",
    "password",
    "security_protocol",
    "sasl_mechanism",
    "ca_location",
)

_LOGIN_MODULES = {
    "PLAIN": "org.apache.kafka.common.security.plain.PlainLoginModule",
    "SCRAM-SHA-256": "org.apache.kafka.common.security.scram.ScramLoginModule",
    "SCRAM-SHA-512": "org.apache.kafka.common.security.scram.ScramLoginModule",
}


def from_environment(text: str, environ: Mapping[str, str] | None = None) -> str:
    """``$NAME`` -> value of NAME; any other text unchanged."""
    if len(text) < 2 or not text.startswith("$"):
        return text
    source = os.environ if environ is None else environ
    if text[1:] not in source:
        raise KeyError(f"environment variable {text[1:]} is not set")
    return source[text[1:]]


@dataclass(frozen=True)
class Connection:
    """Brokers and credentials; empty fields are left to the connector."""

    brokers: str
    group: str = ""
    security_protocol: str = ""
    sasl_mechanism: str = ""
    user: str = ""
    password: str = ""
    ca_location: str = ""

    def resolved(self, environ: Mapping[str, str] | None = None) -> Connection:
        known = {f.name for f in fields(self)} & set(FROM_ENVIRONMENT)
        return replace(
            self,
            **{name: from_environment(getattr(self, name), environ) for name in known},
        )

    def options(self, environ: Mapping[str, str] | None = None) -> dict[str, str]:
        """Reader or writer options, secrets included: do not log them."""
        own = self.resolved(environ)
        options = {"kafka.bootstrap.servers": own.brokers}
        if own.group:
            options["kafka.group.id"] = own.group
        if own.security_protocol:
            options["kafka.security.protocol"] = own.security_protocol
        if own.sasl_mechanism:
            options["kafka.sasl.mechanism"] = own.sasl_mechanism
        if own.user:
            mechanism = own.sasl_mechanism or "PLAIN"
            if mechanism not in _LOGIN_MODULES:
                raise ValueError(f"no login module known for {mechanism}")
            quoted = own.password.replace("\\", "\\\\").replace('"', '\\"')
            options["kafka.sasl.jaas.config"] = (
                f'{_LOGIN_MODULES[mechanism]} required '
                f'username="{own.user}" password="{quoted}";'
            )
        if own.ca_location:
            options["kafka.ssl.truststore.type"] = "PEM"
            options["kafka.ssl.truststore.location"] = own.ca_location
        return options


# Delivery settings of the topic writer: every replica confirms, retry for as long
# as it takes, compressed batches. The checkpoint replays what was not confirmed.
DURABLE_WRITER = {
    "kafka.acks": "all",
    "kafka.retries": "2147483647",
    "kafka.delivery.timeout.ms": "2147483647",
    "kafka.max.block.ms": "9223372036854775807",
    "kafka.request.timeout.ms": "300000",
    "kafka.compression.type": "gzip",
}
