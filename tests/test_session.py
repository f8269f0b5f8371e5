"""The shared folder: as the cluster names it, else one folder of this machine for local masters only."""

import pytest

from tierflow import session


class Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return default if self.value is None else self.value

    def set(self, key, value):
        raise AssertionError("static settings cannot be changed")


class FakeSession:
    def __init__(self, folder, master):
        self.conf = Conf(folder)
        self.sparkContext = type("Context", (), {"master": master})()


def test_shared_folder():
    assert session.shared_folder(FakeSession("file:/shared/", "spark://host")) == "file:/shared"
    own = session.shared_folder(FakeSession(None, "local[4]"))
    assert own and session.shared_folder(FakeSession("", "local")) == own
    with pytest.raises(RuntimeError):
        session.shared_folder(FakeSession(None, "spark://host"))
