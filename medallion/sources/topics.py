"""Kafka topics and Event Hubs through their Kafka endpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.decode import decode_topic
from .base import Source, SourceRequest, reader, register_source

# The secret references that an SSL connection needs.
SSL_SECRETS = (
    "kafka.ssl.truststore.secrets.scope",
    "kafka.ssl.truststore.secrets.key",
    "kafka.ssl.keystore.secrets.scope",
    "kafka.ssl.keystore.secrets.key",
)
PLAIN_LOGIN = "org.apache.kafka.common.security.plain.PlainLoginModule"


def _secret(request: SourceRequest, scope, key) -> str:
    if request.secrets is None:
        raise ValueError("this source needs a secret lookup function")
    return request.secrets(scope, key)


def kafka_options(request: SourceRequest) -> dict[str, str]:
    details = request.details
    built = {
        "kafka.bootstrap.servers": details.get("kafka.bootstrap.servers"),
        "subscribe": details.get("subscribe"),
    }
    stores = [details.get(f"kafka.ssl.{s}.location") for s in ("truststore", "keystore")]
    if all(stores):
        missing = [name for name in SSL_SECRETS if not details.get(name)]
        if missing:
            raise ValueError(f"an SSL connection needs {list(SSL_SECRETS)}; missing {missing}")
        for store, location in zip(("truststore", "keystore"), stores):
            reference = f"kafka.ssl.{store}.secrets"
            built[f"kafka.ssl.{store}.location"] = location
            built[f"kafka.ssl.{store}.password"] = _secret(
                request, details[f"{reference}.scope"], details[f"{reference}.key"]
            )
    return {**built, **request.options}


def eventhub_options(request: SourceRequest) -> dict[str, str]:
    details = request.details
    namespace, key_name = details.get("eventhub.namespace"), details.get("eventhub.accessKeyName")
    host = f"{namespace}.servicebus.windows.net"
    key = _secret(
        request,
        details.get("eventhub.secretsScopeName"),
        details.get("eventhub.accessKeySecretName") or key_name,
    )
    connection = f"Endpoint=sb://{host}/;SharedAccessKeyName={key_name};SharedAccessKey={key}"
    login = f'{PLAIN_LOGIN} required username="$ConnectionString" password="{connection}";'
    built = {
        "kafka.bootstrap.servers": f"{host}:{details.get('eventhub.port')}",
        "subscribe": details.get("eventhub.name"),
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.jaas.config": login,
    }
    return {**built, **request.options}


def _topic_source(options_of):
    def factory(request: SourceRequest) -> Source:
        def rows(streaming: bool) -> DataFrame:
            topic = reader(request.spark, streaming).format("kafka")
            return decode_topic(topic.options(**options_of(request)).load(), request.schema)

        return Source(rows)

    return factory


register_source("kafka", _topic_source(kafka_options))
register_source("eventhub", _topic_source(eventhub_options))
