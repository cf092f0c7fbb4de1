"""S8 over a stubbed transport: what is asked again, what is raised at once."""
import io
import urllib.error

import pytest

from corpusflow.sources.paged_api import PagedApiReader, get_page


def _server(*answers):
    """An opener that gives the answers one after the other, and the list of what was asked."""
    asked, left = [], list(answers)

    def open_url(url, timeout):
        asked.append(url)
        a = left.pop(0)
        if isinstance(a, Exception):
            raise a
        return io.BytesIO(a)
    return open_url, asked


def _status(code, **headers):
    return urllib.error.HTTPError("u?serviceKey=secret", code, "m", headers, None)


def test_busy_servers_and_broken_connections_are_asked_again():
    pauses = []
    open_url, asked = _server(_status(503), ConnectionResetError(), _status(429, **{"Retry-After": "7"}), "ok é".encode())
    assert get_page("u", "shown", open_url, retries=3, backoff=0.5, sleep=pauses.append) == "ok é"
    assert len(asked) == 4 and pauses == [0.5, 1.0, 7.0]


@pytest.mark.parametrize("code", [400, 401, 404, 418])
def test_other_answers_are_raised_at_once(code):
    open_url, asked = _server(_status(code), b"never")
    with pytest.raises(RuntimeError, match=f"status {code} of shown") as e:
        get_page("u?serviceKey=secret", "shown", open_url, sleep=None)
    assert len(asked) == 1 and "secret" not in str(e.value) and e.value.__cause__ is None


def test_retries_end():
    open_url, asked = _server(*[_status(500)] * 3)
    with pytest.raises(RuntimeError, match="status 500"):
        get_page("u", "shown", open_url, retries=2, sleep=lambda s: None)
    assert len(asked) == 3
    open_url, _ = _server(*[TimeoutError()] * 2)
    with pytest.raises(RuntimeError, match="TimeoutError of shown"):
        get_page("u", "shown", open_url, retries=1, sleep=lambda s: None)


def test_pages_are_requested_with_their_parameters(monkeypatch):
    open_url, asked = _server(b'{"a": 1}', b"<r/>")
    monkeypatch.setattr("urllib.request.urlopen", open_url)
    read = PagedApiReader({"base_url": "http://h/", "endpoint": "/items", "service_key": "k&y", "extra": '{"numOfRows": 7}', "api_name": "items", "run_date": "d"})
    assert list(read.read(type("P", (), {"pages": [4]}))) == [("items", "d", 4, "json", '{"a": 1}')]
    xml = PagedApiReader({"base_url": "http://h", "endpoint": "items", "service_key": "k", "format": "xml"})
    assert [r[4] for r in xml.read(type("P", (), {"pages": [1]}))] == ["<r/>"]
    assert asked == ["http://h/items?serviceKey=k%26y&type=json&pageNo=4&numOfRows=7", "http://h/items?serviceKey=k&pageNo=1&numOfRows=100"]
