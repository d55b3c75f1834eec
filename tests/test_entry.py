import subprocess
import sys
import textwrap


def test_the_rest_is_offered_when_a_module_of_the_optional_part_is_missing():
    """A missing third-party module costs the training-data queries only, with a warning."""
    code = textwrap.dedent("""
        import sys, warnings
        sys.modules["ahocorasick"] = None                     # as if it were not installed
        with warnings.catch_warnings(record=True) as seen:
            warnings.simplefilter("always")
            import __spark_entry__ as E
        llm = [q for q in E.queries() if q.startswith("op") and q[2:3].isdigit()]
        print(len(E.queries()) > 90, llm, any("left out" in str(w.message) for w in seen))
    """)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=__file__.rsplit("/tests/", 1)[0], timeout=120)
    assert out.stdout.strip() == "True [] True", out.stderr[-500:]
