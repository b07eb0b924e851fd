"""Incremental intake: new files only, replays do not duplicate rows."""

import os
import tempfile

from conftest import SF_SMALL
from formlens.plans import derived as D
from formlens.streaming import read_intake, start_intake


def test_intake_is_incremental(spark):
    base = tempfile.mkdtemp(prefix="formlens-stream-")
    form = D.survey_form(spark, SF_SMALL)
    total = form.count()
    D.write_form_exports(form, os.path.join(base, "inbox"))
    args = (os.path.join(base, "inbox", "*"), os.path.join(base, "sink"), os.path.join(base, "ckpt"), 1998)
    start_intake(spark, *args, keep=["respondent_id", "file_id"], filter_by_year=False).awaitTermination()
    first = read_intake(spark, args[1])
    assert first.count() == total
    # a second run over the same checkpoint finds no new file and writes nothing
    start_intake(spark, *args, keep=["respondent_id", "file_id"], filter_by_year=False).awaitTermination()
    assert read_intake(spark, args[1]).count() == total
    assert first.select("respondent_id").distinct().count() == total
