"""What the FASTQ reader holds at once does not grow with the file."""

from cytoframe.sources import records


def test_batches_of_a_long_file_stay_small(tmp_path):
    n = 150_000
    (tmp_path / "a.fastq").write_text("".join(f"@{i} runid=r\nACGTACGTACGTACGT\n+\nIIIIIIIIIIIIIIII\n" for i in range(n)))
    system, _ = records.file_system(str(tmp_path))
    sizes = [b.num_rows for b in records.fastq_batches(system, str(tmp_path / "a.fastq"), None, 0, -1, "error")]
    assert sum(sizes) == n and max(sizes) < n // 3
