"""Runs from the command line: pre-flight checks, modes, verdicts, a model service on this machine."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from alertloom.functions import vocab as v
from alertloom.operators import audit
from alertloom.plans import pipeline, quotas
from alertloom.plans.quotas import Options
from alertloom.sources import model, scratch
from alertloom.sources.names import read_alerts, write_alerts, world_names


class Service(BaseHTTPRequestHandler):
    """Answers every second request of a pair with something that can't be used."""

    asked: dict[str, int] = {}

    def _send(self, data):
        body = json.dumps(data).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def do_GET(self):
        self._send({"models": [{"name": "small:1b"}, {"name": "gemma4:31b-cloud"}]})

    def do_POST(self):
        told = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        user = told["messages"][1]["content"]
        n = self.asked[user] = self.asked.get(user, 0) + 1
        code = user.partition("The difference to explain is ")[2].partition(" ")[0]
        decision = v.DISQUALIFY if "'disqualify'" in user else v.ESCALATE
        good = json.dumps({"thinking": "Names compared.", "decision": decision, "disposition_code": code})
        self._send({"message": {"content": "thinking ..." if n == 1 and len(user) % 2 else good}})

    def log_message(self, *_):
        pass


@pytest.fixture()
def service():
    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_unusable_answers_are_asked_again():
    said, waits = ["no", '{"decision": "escalate"}', '```json\n{"reasoning": "r"}\n```'], []
    assert model.ask(lambda s, u: said.pop(0), "", "", waits.append).startswith("```") and waits == [1.0, 2.0]


def test_a_run_that_needs_a_model_fails_without_one(spark, capsys, tmp_path):
    with pytest.raises(SystemExit):
        pipeline.main(["-n", "50", "--model_url", "http://127.0.0.1:9", "-o", str(tmp_path / "x")])
    out = capsys.readouterr().out
    assert "--ollama_percentage 0" in out and "--num_gender_variants 0" in out
    with pytest.warns(UserWarning, match="no model client"):
        pipeline.run(spark, Options(total_samples=20, disposition_balance="off"))


def test_command_line_offline(spark, capsys, tmp_path):
    pipeline.main(["-n", "60", "--ollama_pct", "0", "--fuzzy_pct", "100", "--num_gender_variants", "3", "--disposition_balance", "even", "--no-faker_names", "-o", str(tmp_path / "out")])
    out = capsys.readouterr().out
    assert "0 for the model" in out and out.count("PASSED") == 5 and "FAILED" not in out and "Pre-flight" in out
    got = read_alerts(spark, str(tmp_path / "out"))
    assert got.count() == 60 and len(list((tmp_path / "out").glob("part-*"))) == 1


def test_command_line_with_a_model(spark, service, capsys, monkeypatch, tmp_path):
    monkeypatch.setattr(model, "backoff", lambda *_: 0.0)
    pipeline.main(["-n", "40", "--model_url", service, "--ollama_pct", "50", "--fuzzy_pct", "50", "-o", str(tmp_path / "out")])
    out = capsys.readouterr().out
    assert out.count("PASSED") == 5 and "fallbacks: 0" in out and "errors: 0" in out
    got = read_alerts(spark, str(tmp_path / "out"))
    asked = quotas.model_load(c := quotas.resolve_counts(Options(total_samples=40, ollama_percentage=50.0, fuzzy_percentage=50.0)), quotas.resolve_plan(spark, Options(), c))
    assert got.where("created_by = 'ollama'").count() == asked > 0


def test_short_runs_are_counted_and_tolerated(spark):
    names = spark.createDataFrame([("Wei Zhang",), ("Ana Lopez",)], "client_name string")
    plan = spark.createDataFrame([("DISP_TOKEN_ORDER_SWAP", 5), ("DISP_MINOR_TYPO", 5)], "code string, quota long")
    kept = {}
    alerts = pipeline.balanced(names, plan, allow_short=True, kept=kept)
    figures = pipeline.metrics(alerts, 1.0, kept)
    assert figures["short"] == 3 and figures["records"] == 7
    counts = quotas.resolve_counts(Options(num_true_positives=10, num_false_positives=0, num_exact_matches=0, num_gender_variants=0))
    assert all(ok for _, ok, _ in pipeline.verdicts(alerts, counts, plan, figures["short"]))
    assert [name for name, ok, _ in pipeline.verdicts(alerts, counts, plan) if not ok] == ["Disposition balance"]


def test_verdicts_name_what_is_wrong(spark):
    rows = [("Ana Li", "Ana Li", "DISP_MINOR_TYPO", v.ESCALATE, "x"), ("Daniel Li", "Daniela Li", "DISP_MINOR_TYPO", v.ESCALATE, "x"), ("Ana Li", "Ana Li", "DISP_MINOR_TYPO", v.ESCALATE, "x")]
    bad = spark.createDataFrame(rows, "client_name string, hit_name string, disposition_code string, decision string, thinking string")
    counts = quotas.resolve_counts(Options(total_samples=10, num_exact_matches=1, num_gender_variants=1))
    assert not any(ok for _, ok, _ in pipeline.verdicts(bad, counts))
    assert audit.integrity_verdict(bad, 2, 0).first().ok is False


def test_scratch_is_cleared(spark):
    df = scratch.cut(world_names(spark))
    assert df.count() > 100 and scratch.clear(spark) >= 1
    assert scratch.clear(spark) == 0


def test_files_of_few_rows(spark, tmp_path):
    alerts = world_names(spark).select(*[F.col("name").alias(c) for c in v.OUTPUT])
    write_alerts(alerts.coalesce(1), str(tmp_path / "out"), rows_per_file=50)
    assert len(list((tmp_path / "out").glob("part-*"))) == 3 and read_alerts(spark, str(tmp_path / "out")).count() == alerts.count()
