"""Trees of pages are freed at once."""

import gc
import weakref

from millrace.functions import html


def test_trees_go_without_a_search_for_cycles():
    gc.disable()
    try:
        root = html.parse("<html><body><div><p>a<p>b</div></body></html>")
        node = weakref.ref(next(html.select(root, "div p")))
        assert node().parent.tag == "div"
        del root
        assert node() is None
    finally:
        gc.enable()
