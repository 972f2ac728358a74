from __future__ import annotations

import pytest

from brokerflow.plans.scratch import release
from brokerflow.checks.session import make_session


@pytest.fixture(scope="session")
def spark():
    session = make_session(cpus=4, name="tests")
    yield session
    release(session)
    session.stop()


@pytest.fixture
def no_broadcast(monkeypatch):
    """Make every measured lookup too large to broadcast."""
    monkeypatch.setattr("brokerflow.plans.scratch.BROADCAST_BYTES", -1)
