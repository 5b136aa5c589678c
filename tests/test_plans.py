"""What the optimizer makes of the jobs."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from massloom.fixtures import views
from massloom.operators import inventory
from massloom.plans import breakdown, intensity, run_metadata, scan_metadata
from massloom.session import durable
from massloom.sources.tables import sized_samples


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def final_plan(df) -> str:
    """The adaptive plan after running; ``df`` must be small."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_sized_samples_reach_the_scan(spark, sf):
    files = views.stored_files(spark, sf)
    text = plan(sized_samples(files))
    assert "PushedFilters: [IsNotNull(id)]" in text
    assert "ReadSchema: struct<id:string,size_bytes:bigint>" in text


def test_olap_cuts_scan_once(spark, sf):
    """The data is grouped in one job; what follows reads the grouped rows."""
    files = views.stored_files(spark, sf)
    data = durable(breakdown.dataset(views.replicates(spark, sf, files), files), "data")
    cuts = breakdown.olap_cuts(data)
    text = cuts._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in text and "groups-" in plan(cuts) and "data-" not in plan(cuts)


def test_listing_shuffle_is_shared(spark, sf):
    rows = views.listing(spark, sf)
    assert "ReusedExchange" in final_plan(inventory.fuse(inventory.contributions(rows)).agg(F.sum("size_bytes")))


def test_peak_work_stays_in_the_row(spark, sf):
    spectra = durable(views.spectra(spark, sf), "spectra")
    for df in (
        intensity.histogram(spectra),
        intensity.quantiles(spectra),
        scan_metadata.peak_stats(spectra),
        scan_metadata.scan_metadata(spectra, 1),
        run_metadata.run_measures(spectra),
    ):
        text = plan(df)
        assert "Python" not in text and "ArrowEval" not in text
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert plan(scan_metadata.peak_stats(spectra)).count("Exchange") == 0


def test_inferred_filters_do_not_copy_the_work(spark, sf):
    """The explodes are outer ones, so no filter repeats the peak statistics."""
    spectra = durable(views.spectra(spark, sf), "spectra")
    text = plan(run_metadata.run_measures(spectra))
    filters = [line for line in text.splitlines() if line.startswith("Condition")]
    assert not any("sort_array" in line for line in filters)


def test_peaks_are_read_once(spark, sf):
    """What follows the one pass over the peaks reads what was made of them."""
    spectra = views.spectra(spark, sf)
    for made in (intensity.histogram(spectra), intensity.quantiles(spectra), scan_metadata.scan_metadata(spectra, 1)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "embedding" not in plan
