"""Command-line jobs: exit status follows the load outcome."""

from landfall.__main__ import main
from landfall.sinks.audit import read_audit
from tests.conftest import write_text

HDR = "Patient MRN|Admit Date or Service Date\n"


def test_load_job_exit_status(spark, workdir, capsys):
    ok = write_text(f"{workdir}/in/patient_visits_1.txt", HDR + "1|1/5/2024\n")
    bad = write_text(f"{workdir}/in/patient_visits_2.txt", HDR + "2|garbage\n")
    common = ["--lake", f"{workdir}/lake", "--audit", f"{workdir}/audit"]
    assert main(["load", "--feed", "visits", "--input_path", ok, *common]) == 0
    assert main(["load", "--feed", "visits", "--input_path", bad, *common]) == 1
    assert '"status": "FAILED"' in capsys.readouterr().out
    assert read_audit(spark, f"{workdir}/audit").count() == 2


def test_intake_job(spark, workdir):
    write_text(f"{workdir}/landing/patient_visits_1.txt", HDR + "1|1/5/2024\n")
    args = ["intake", "--landing", f"{workdir}/landing", "--lake", f"{workdir}/lake",
            "--audit", f"{workdir}/audit", "--checkpoint", f"{workdir}/ckpt", "--glob", "*.txt"]
    assert main(args) == 0
    assert [r["status"] for r in read_audit(spark, f"{workdir}/audit").collect()] == ["SUCCEEDED"]
