"""Kafka security option builders (pure functions)."""

import pytest

from kpiflow.settings import Settings
from kpiflow.sources.files import object_store_conf
from kpiflow.sources.kafka import KafkaSecurity, kafka_reader_options


def test_protocol_follows_from_the_credentials():
    assert KafkaSecurity().protocol == "PLAINTEXT"
    assert KafkaSecurity(username="user", password="pw").protocol == "SASL_PLAINTEXT"
    assert KafkaSecurity("sasl_ssl", username="user", password="pw").protocol == "SASL_SSL"


def test_plaintext_and_ssl_options():
    assert KafkaSecurity("PLAINTEXT").options() == {}
    assert KafkaSecurity("ssl").options() == {"kafka.security.protocol": "SSL"}


@pytest.mark.parametrize(
    "given", [dict(username="user"), dict(password="pw"), dict(protocol="SASL_SSL"), dict(username="a", password="b", mechanism="GSSAPI")]
)
def test_inconsistent_settings_are_refused(given):
    with pytest.raises(ValueError):
        KafkaSecurity(**given)


def test_login_line_and_no_plain_credentials():
    secure = KafkaSecurity("SASL_SSL", "SCRAM-SHA-256", "alice", "s3cret")
    opts = secure.options()
    jaas = opts["kafka.sasl.jaas.config"]
    assert "ScramLoginModule" in jaas and 'username="alice"' in jaas and 'password="s3cret"' in jaas
    assert not any(k.endswith("sasl.username") or k.endswith("sasl.password") for k in opts)
    assert "PlainLoginModule" in KafkaSecurity(mechanism="plain", username="a", password="b").options()["kafka.sasl.jaas.config"]
    assert "s3cret" not in repr(secure)


def test_reader_options():
    opts = kafka_reader_options("broker:9092", "clicks", security=KafkaSecurity("SSL"))
    assert opts["maxOffsetsPerTrigger"] == "60000" and opts["failOnDataLoss"] == "false"
    assert kafka_reader_options("b", "t", Settings(fail_on_data_loss=True))["failOnDataLoss"] == "true"
    assert opts["startingOffsets"] == "latest" and opts["kafka.security.protocol"] == "SSL"


def test_object_store_conf_needs_credentials():
    with pytest.raises(ValueError):
        object_store_conf("http://store:9000", "", "")
    conf = object_store_conf("http://store:9000", "k", "s")
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
