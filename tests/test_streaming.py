import json
import os
import tempfile

from pixelchange.sources import standins
from pixelchange.sources import tables as T
from pixelchange.streaming.chunks import detection_stream

from .conftest import SF_SMALL


def test_detection_stream_incremental(spark, tmp_root):
    obs = standins.observations(spark, SF_SMALL)
    chips = sorted({(r.cx, r.cy) for r in obs.select("cx", "cy").distinct().collect()})[:6]
    ids_dir = tempfile.mkdtemp(prefix="pc-ids-")
    ckpt = tempfile.mkdtemp(prefix="pc-stream-")

    def drop(name, part):
        with open(os.path.join(ids_dir, name), "w") as f:
            f.writelines(json.dumps({"cx": cx, "cy": cy}) + "\n" for cx, cy in part)

    drop("a.json", chips[:3])
    q = detection_stream(spark, ids_dir, obs, tmp_root, name="t1", checkpoint_location=ckpt)
    q.awaitTermination(600)
    assert q.exception() is None
    first = {(r.cx, r.cy) for r in T.scan_table(spark, tmp_root, "chip").collect()}
    assert first == set(chips[:3])
    drop("b.json", chips[3:])
    q = detection_stream(spark, ids_dir, obs, tmp_root, name="t2", checkpoint_location=ckpt)
    q.awaitTermination(600)
    done = {(r.cx, r.cy) for r in T.scan_table(spark, tmp_root, "chip").collect()}
    assert done == set(chips)
    segs = T.scan_table(spark, tmp_root, "segment").select("cx", "cy").distinct().count()
    assert segs == len(chips)
